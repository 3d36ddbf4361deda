"""Quality measures against plain Python; limits that follow the data."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from kestrel.llm.quality_rules import merged, quality_verdicts, quantiles, sketch_counts, text_measures
from kestrel.llm.queries import op6_quality_rules

CHECK = "/root/testdata/sf0.01"
TRICKY = ["", None, " \n \n", "a\na\n\na \na", "x y z x y z q", "# $ %% é|漢 <>\n# $ %% é|漢 <>", "a a a a", "one\r\none\r\n", "tail\n", "\n\nhead"]


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again, lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += 1
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered), lines


def test_measures_match_python(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id int, text string").repartition(2)
    for r in text_measures(df).collect():
        assert tuple(r)[1:] == measures(TRICKY[r["doc_id"]])


def test_whole_table(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{CHECK}/documents.parquet").collect()}
    rows = op6_quality_rules(spark, CHECK).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, chars, symbols, lines, repeats, _ = measures(docs[r["doc_id"]]["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, repeats)
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)
        assert r["kept"] == (not r["base_failed"] and r["beyond"] == "")
    good = {r["doc_id"] for r in spark.read.parquet(f"{CHECK}/labels.parquet").where("quality = 1").collect()}
    sound = [r for r in rows if r["doc_id"] in good and not r["base_failed"]]
    assert sum(r["kept"] for r in sound) >= 0.98 * len(sound)


def test_sketches_merge_and_keep_their_error(spark):
    rng = random.Random(4)
    rows = [(k % 3, 10 + rng.randrange(90), rng.randrange(400), rng.randrange(30), 0, 0, 5) for k in range(3000)]
    df = spark.createDataFrame(rows, "g int, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint")
    fine = sketch_counts(df, ("g",))
    got = {r["measure"]: r for r in quantiles(merged(fine, ()), (), {"q50": 0.5, "q90": 0.9}).collect()}
    for name, value in (("word_length", lambda r: r[2] / r[1]), ("symbol_share", lambda r: r[3] / r[1])):
        true = sorted(map(value, rows))
        for q, p in (("q50", 0.5), ("q90", 0.9)):
            assert abs(got[name][q] / true[int(p * len(rows)) - 1] - 1) < 0.025
        assert got[name]["total"] == len(rows)
    assert got["repeat_share"]["q90"] == 0.0
    whole = quantiles(sketch_counts(df.withColumn("g", F.lit(1)), ("g",)), ("g",), {"q50": 0.5}).where("measure = 'word_length'").first()
    assert whole["q50"] == got["word_length"]["q50"]


def test_limits_adapt_to_language_and_source(spark):
    """The same share of symbols is usual in one source and far out in another."""
    rng = random.Random(1)
    body = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    code = lambda: " ".join(f"w{rng.randrange(10**6)} #" for _ in range(60))
    rows = [(k, body(), "en", "prose") for k in range(150)] + [(200 + k, code(), "en", "code") for k in range(150)] + [(999, code(), "en", "prose")]
    got = {r["doc_id"]: r for r in quality_verdicts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert not got[999]["kept"] and "symbol_share" in got[999]["beyond"]
    assert all(r["kept"] for i, r in got.items() if i != 999)


def test_odd_rows(odd_docs, no_docs):
    rows = quality_verdicts(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["base_failed"] and not by_id[i]["kept"] for i in (4, 5, 6, 7, 10))
    assert quality_verdicts(no_docs).count() == 0


def plain_verdicts(rows, reach=4.0, min_docs=30, error=0.01, noise=4.0):
    """Limits and verdicts in plain Python: sketches as counters, merged by adding."""
    import math
    from collections import Counter, defaultdict
    step = math.log((1 + error) / (1 - error))
    bucket = lambda v: -10**6 if v < 1e-4 else math.ceil(math.log(v) / step)
    value = lambda b: 0.0 if b == -10**6 else 2 * math.exp(b * step) / (math.exp(step) + 1)
    sketches, seen = defaultdict(Counter), Counter()
    measured = []
    for i, text, lang, source in rows:
        n, chars, symbols, dup, repeats, lines = measures(text)
        failed = n < 50 or 100 * repeats > 50 * n
        shares = {"word_length": chars / max(n, 1), "symbol_share": symbols / max(n, 1), "dup_line_share": dup / max(lines, 1), "repeat_share": repeats / max(n, 1)}
        counts = {"symbol_share": (symbols, n, 1), "dup_line_share": (dup, lines, 1), "repeat_share": (repeats, n, 6)}
        measured.append((i, lang, source, failed, shares, counts))
        if not failed:
            for level in ((lang, source), (lang,), ()):
                seen[level] += 1
                for m, v in shares.items():
                    sketches[level, m][bucket(v)] += 1

    def quantile(level, m, p):
        upto = 0
        for b in sorted(sketches[level, m]):
            upto += sketches[level, m][b]
            if upto >= p * seen[level]:
                return value(b)

    out = {}
    for i, lang, source, failed, shares, counts in measured:
        level = next((x for x in ((lang, source), (lang,)) if seen[x] >= min_docs), ())
        beyond = []
        for m, v in shares.items() if seen[lang, source] else ():
            lo, mid, hi, top, low = (quantile(level, m, p) for p in (0.1, 0.5, 0.9, 0.95, 0.05))
            up = max(top, hi + reach * (hi - mid)) * (1 + 2 * error)
            if m == "word_length":
                bad = v > up or v < min(low, lo - reach * (mid - lo)) * (1 - 2 * error)
            else:
                k, n, clump = counts[m]
                bad = k > up * n + noise * math.sqrt(clump * (up * n + clump))
            beyond += [m] if bad else []
        out[i] = (failed, ",".join(beyond))
    return out


def test_verdicts_equal_a_plain_computation(spark):
    rng = random.Random(8)
    rows = []
    for k in range(400):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None])
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(10 ** rng.randint(1, 7))}" for _ in range(rng.randint(20, 200))]
        if rng.random() < 0.05:
            words = [w + "#$"[: rng.randint(1, 2)] for w in words]
        if rng.random() < 0.1:
            words = words + words[: len(words) // 3]
        cut = rng.randint(1, 30)
        lines = [" ".join(words[i: i + cut]) for i in range(0, len(words), cut)]
        rows.append((k, "\n".join(lines + lines[:2] * rng.choice([0, 0, 0, 3])), lang, source))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: (r["base_failed"], r["beyond"]) for r in quality_verdicts(df, min_docs=30).collect()}
    want = plain_verdicts(rows)
    assert got == want
    rejected = [b for f, b in want.values() if not f and b]
    assert len(rejected) > 5 and any("symbol_share" in b for b in rejected)


def test_clean_documents_stay_and_symbol_soup_goes(spark):
    """Where 95 of 100 texts have no symbol, a text full of them is out and one symbol is not."""
    rng = random.Random(2)
    body = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = [(k, body(100), "en", "s") for k in range(200)] + [(500 + k, body(100).replace(" ", " # ", 35), "en", "s") for k in range(4)]
    rows += [(600, body(100) + " 5%", "en", "s"), (601, body(2000) + " <b>", "en", "s")]
    got = {r["doc_id"]: r["kept"] for r in quality_verdicts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert [i for i, kept in got.items() if not kept] == [500, 501, 502, 503]
