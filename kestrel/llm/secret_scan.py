"""Secret scan with sliding-window entropy (operator 4), in DataFrame functions only.

Base kinds are patterns: ``assign`` (a credential name, a separator and a value),
``access`` (access key ids) and ``hex`` (long runs of hex digits).

Candidate strings are long runs of key characters. Along each a window slides one
character at a time; only the counts of the character that enters and the one
that leaves change, so the sum of ``c * log2(c)`` over the counts, and with it the
Shannon entropy, is updated by their differences. A window above the limit of the
string's character class (hex digits, one case with digits, both cases with
digits) is part of a secret; the span runs from the first such window to the last.
Strings of letters alone have no class and are never reported. Stretches on the
allow list (UUIDs, placeholders, counting runs) and base spans are cut out of a
string, and the window runs over each piece that is left; base spans always stay.
Pieces that start with ``/`` or ``-`` and consist of words and numbers are paths,
hosts or options and not reported.

The work on a text is linear in its length, but for the lookup of many spans, which
goes through blocks of 256: what a lambda needs is computed once and handed in.

Positions are code points, ends exclusive. Null texts count as empty and have no
span. Repeated rows get equal answers; an empty table an empty result. Columns
named like the results are replaced by them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order in which ties are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{WINDOW},}}"
# Bits a character, per class.
LIMITS = {"hex": 2.9, "one_case": 3.5, "two_cases": 3.8}


def _counting(letters: str, least: int) -> str:
    """The first ``least`` characters and as many of the next as follow."""
    more = ""
    for c in reversed(letters[least:]):
        more = f"(?:{c}{more})?"
    return letters[:least] + more


#: Stretches of a candidate string; what is around them is still searched.
ALLOWED = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY",
    r"(?i)[_-]?(?:example|sample|dummy|placeholder|changeme|your[_-]?(?:key|token|secret)|x{4,})[_-]?",
    rf"0123456789|(?i:{_counting('abcdefghijklmnopqrstuvwxyz', 10)})",
    r"(?i)\bhttps?",
)
# Words in one case or camel case, with a few digits after, or numbers.
_WORD = r"(?:(?:[A-Z]?[a-z]{2,}+){1,12}+|[A-Z]{2,}+|[A-Za-z])[0-9]{0,4}|[0-9]+"
_BLOCK = 256
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_SPAN = "array<struct<start:int,end:int,rank:int,token:string>>"


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once. Inside the lambda of a higher-order
    function an outer expression would be computed anew for every element."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _blocks(xs: Column) -> Column:
    n_blocks = F.ceil(F.size(xs) / _BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(xs, b * _BLOCK + 1, F.lit(_BLOCK)))


def _before(xs: Column, add=lambda a, x: a + x) -> Column:
    """For each element the sum (or what ``add`` makes) of those before it, 0 at first,
    in blocks so that long arrays cost little more than short ones."""
    total = lambda part: F.aggregate(part, F.lit(0), add)
    inside = lambda block, start: F.transform(block, lambda _, j: add(start, total(F.slice(block, F.lit(1), j))))
    parts = _let(_blocks(xs), lambda blocks: _let(F.transform(blocks, total), lambda sums: F.transform(
        blocks, lambda block, b: _let(total(F.slice(sums, F.lit(1), b)), lambda start: inside(block, start)))))
    return F.when(F.size(xs) > 0, F.flatten(parts)).otherwise(F.array().cast("array<int>"))


def located(text: Column, pattern: str, kind: str, least: int, group: int = 0, searched: str | None = None) -> Column:
    """Leftmost non-overlapping matches whose ``group`` has ``least`` characters, as
    (start, end, rank, token). The pieces between matches give the positions."""
    searched = searched or pattern
    hits, gaps = F.regexp_extract_all(text, F.lit(searched), F.lit(0)), F.split(text, searched, -1)
    sized = F.regexp_extract_all(text, F.lit(searched), F.lit(group)) if group else hits
    found = F.struct(hits.alias("hits"), F.transform(gaps, lambda g: F.length(g)).alias("gaps"), F.transform(sized, lambda g: F.length(g)).alias("sizes"))

    def spans(m: Column) -> Column:
        lengths = F.transform(m["hits"], lambda h, i: F.length(h) + F.get(m["gaps"], i))
        return _let(lengths, lambda ls: _let(_before(ls), lambda starts: F.transform(m["hits"], lambda h, i: F.struct(
            (F.get(starts, i) + F.get(m["gaps"], i)).alias("start"), (F.get(starts, i) + F.get(ls, i)).alias("end"),
            F.lit(KINDS.index(kind)).alias("rank"), h.alias("token"), F.get(m["sizes"], i).alias("size")))))

    kept = F.transform(F.filter(_let(found, spans), lambda s: s["size"] >= least), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["token"].alias("token")))
    return F.when(text.rlike(searched), kept).otherwise(F.array().cast(_SPAN))


def _f(c: Column) -> Column:
    """c * log2(c), 0 for 0."""
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def entropy_span(token: Column, limit: Column, window: int = WINDOW) -> Column:
    """(lo, hi): where windows of the token reach ``limit`` bits a character; hi is 0
    where none does. The counts of the window, one per character of the alphabet, are
    carried from step to step."""
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(_ALPHABET), c) - 1)

    def step(codes: Column):
        def fn(state: Column, i: Column) -> Column:
            came, left = F.get(codes, i), F.get(codes, i - window)   # no one leaves at first
            n_came, n_left = F.get(state["counts"], came), F.coalesce(F.get(state["counts"], left), F.lit(0))
            same = F.coalesce(came == left, F.lit(False))
            counts = F.when(same, state["counts"]).otherwise(F.transform(state["counts"], lambda n, c: F.when(c == came, n + 1).when(c == left, n - 1).otherwise(n)))
            moved = _f(n_came + 1) - _f(n_came) + F.when(left.isNull(), 0.0).otherwise(_f(n_left - 1) - _f(n_left))
            total = F.when(same, state["s"]).otherwise(state["s"] + moved)
            return _let(total, lambda t: _let((i >= window - 1) & (math.log2(window) - t / window >= limit), lambda rich: F.struct(
                counts.alias("counts"), t.alias("s"), F.when(rich & (state["hi"] == 0), i - window + 1).otherwise(state["lo"]).alias("lo"),
                F.when(rich, i + 1).otherwise(state["hi"]).alias("hi"))))
        return fn

    start = F.struct(F.array_repeat(F.lit(0), len(_ALPHABET)).alias("counts"), F.lit(0.0).alias("s"), F.lit(0).alias("lo"), F.lit(0).alias("hi"))
    return _let(codes, lambda cs: F.aggregate(F.sequence(F.lit(0), F.size(cs) - 1), start, step(cs)))


def _class_limit(token: Column) -> Column:
    digit, lower, upper = token.rlike("[0-9]"), token.rlike("[a-z]"), token.rlike("[A-Z]")
    hexes = token.rlike("^([0-9a-f]+|[0-9A-F]+)$") & (lower | upper)
    return (F.when(hexes & digit, LIMITS["hex"]).when(digit & lower & upper, LIMITS["two_cases"])
            .when(digit & (lower | upper), LIMITS["one_case"]))


def _path(token: Column) -> Column:
    return token.rlike("^[/-]") & F.forall(F.split(token, "[/_-]+"), lambda w: (w == "") | w.rlike(f"^(?:{_WORD})$"))


def _blanked(token: Column, pattern: str) -> Column:
    """The token with as many blanks in place of each match."""
    hits = F.regexp_extract_all(token, F.lit(pattern), F.lit(0))
    pieces = _let(hits, lambda hs: F.transform(F.split(token, pattern, -1), lambda g, i: F.concat(
        g, F.repeat(F.lit(" "), F.coalesce(F.length(F.get(hs, i)), F.lit(0))))))
    return F.when(token.rlike(pattern), F.array_join(pieces, "")).otherwise(token)


def _grouped(base: Column) -> Column:
    """Sorted spans in blocks with their reach, so that few are looked at for a place."""
    return F.transform(_blocks(base), lambda block: F.struct(
        F.get(block, F.lit(0))["start"].alias("start"), F.array_max(F.transform(block, lambda s: s["end"])).alias("end"), block.alias("spans")))


def _without(token: Column, start: Column, base: Column) -> Column:
    """The token, found at ``start``, with blanks in place of the spans of ``base``
    (``_grouped``)."""
    meets = lambda s: (s["start"] < start + F.length(token)) & (start < s["end"])
    over = F.filter(F.flatten(F.transform(F.filter(base, meets), lambda b: b["spans"])), meets)

    def cut(spans: Column) -> Column:
        folded = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), lambda a, b: F.struct(
            F.concat(a["out"], token.substr(a["at"] + 1, F.greatest(b["start"] - start - a["at"], F.lit(0))),
                     F.repeat(F.lit(" "), F.least(b["end"] - start, F.length(token)) - F.greatest(b["start"] - start, a["at"]))).alias("out"),
            F.greatest(a["at"], F.least(b["end"] - start, F.length(token))).alias("at")))
        rest = _let(folded, lambda f: F.concat(f["out"], token.substr(f["at"] + 1, F.length(token))))
        return F.when(F.size(spans) > 0, rest).otherwise(token)

    return _let(over, cut)


def entropy_spans(text: Column, base: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Spans of the rich pieces of candidate strings that are left without allowed
    stretches and base spans; ``base`` is sorted."""
    pattern = "|".join(f"(?:{p})" for p in allowed)
    cleared = lambda token: _blanked(token, pattern) if allowed else token

    def pieces(blocks: Column) -> Column:
        runs = F.transform(located(text, CANDIDATE, "entropy", WINDOW), lambda s: F.struct(s["start"].alias("start"), cleared(s["token"]).alias("token")))
        runs = F.transform(runs, lambda s: F.struct(s["start"].alias("start"), _without(s["token"], s["start"], blocks).alias("token")))
        return F.flatten(F.transform(runs, lambda r: F.transform(located(r["token"], CANDIDATE, "entropy", WINDOW), lambda s: F.struct(
            (r["start"] + s["start"]).alias("start"), s["token"].alias("token"), _class_limit(s["token"]).alias("limit")))))

    strings = F.filter(_let(_grouped(base), pieces), lambda s: s["limit"].isNotNull() & ~_path(s["token"]))
    found = F.transform(strings, lambda s: F.struct(s["start"].alias("at"), s["token"].alias("token"), entropy_span(s["token"], s["limit"]).alias("w")))
    spans = F.transform(F.filter(found, lambda x: x["w"]["hi"] > 0), lambda x: F.struct(
        (x["at"] + x["w"]["lo"]).alias("start"), (x["at"] + x["w"]["hi"]).alias("end"),
        F.lit(KINDS.index("entropy")).alias("rank"), x["token"].alias("token")))
    return F.when(text.rlike(CANDIDATE), spans).otherwise(F.array().cast(_SPAN))


def scan(df: DataFrame, text_col: str = "text", base_out: str = "base_spans", all_out: str = "secret_spans",
         allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """All columns of ``df`` with two arrays of spans (start, end, rank in ``KINDS``,
    token): those of the base kinds, and those with the entropy spans, sorted."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    # Runs shorter than the least length cannot pass, so they need not be matched.
    base = F.concat(located(text, ASSIGN, "assign", LEAST_VALUE, group=2),
                    located(text, ACCESS, "access", LEAST_ACCESS, searched=rf"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}"),
                    located(text, HEX, "hex", LEAST_HEX, searched=rf"[0-9a-f]{{{LEAST_HEX},}}"))
    with_base = df.withColumn(base_out, _sorted(base))
    more = entropy_spans(text, F.col(base_out), allowed)
    return with_base.withColumn(all_out, _sorted(F.concat(F.col(base_out), more)))


def _sorted(spans: Column) -> Column:
    key = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["token"].alias("token")))
    return F.transform(F.array_sort(key), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["token"].alias("token")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("bigint")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each stretch of overlapping spans replaced by ``mark``."""
    ends = F.transform(spans, lambda s: s["end"])
    pieces = lambda upto: F.transform(spans, lambda s, i: F.when(s["start"] >= F.get(upto, i), F.concat(
        text.substr(F.get(upto, i) + 1, s["start"] - F.get(upto, i)), F.lit(mark))).otherwise(F.lit("")))
    whole = F.concat(F.array_join(_let(_before(ends, lambda a, x: F.greatest(a, x)), pieces), ""), text.substr(F.array_max(ends) + 1, F.length(text)))
    return F.when(F.size(spans) > 0, whole).otherwise(text)
