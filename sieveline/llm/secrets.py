"""Secret scans (operator 3): strong patterns, and multipart credentials linked by an interval join. Native only.

Base spans are the leftmost non-overlapping matches of three patterns, each kept if long enough:
  assign  a secret-like name, a separator and a value of 8 or more characters
  access  an access identifier of 16 or more characters
  hex     a run of 32 or more lower-case hexadecimal digits
Three more patterns are weak by themselves: `ident` (an id-like name with a value), `secret` (a free-standing run of
40 base64 characters with lower case, upper case and a digit) and `endpoint` (a URL, or a host or address with a
port; a host is lower-case labels joined by points, the first without one before it). Their matches are reported only if complementary parts stand in one scope: an identifier (access, ident) and
a secret (assign, hex, secret) whose distance is at most SCOPE characters are linked; an endpoint is reported if both
an identifier and a secret are in its scope. The links come from interval joins dealt by (row, stretch of text), and
only the existence of a partner is asked for, so no list of pairs is made and a crowded document is no single task.

Defined cases: null counts as empty; offsets are code points, ends exclusive; rows are independent of each other, so
ties and repeated rows give equal rows; a base span is never dropped, and a weak span that equals a base span in
extent is reported beside it; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.llm.common import Stages, pick

KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
# fixed values: the base patterns
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# the weak patterns
IDENT = r"""(?i)\b(?:client|account|tenant|access_?key|user)[_-]?id["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}"""
SECRET = r"(?<![A-Za-z0-9+/=_-])(?=[A-Z+/0-9]*[a-z])(?=[a-z+/0-9]*[A-Z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
# a host is tried only where a run of its characters begins, and no step gives back what it took: linear in the text,
# and without a repeated group, on which the matcher would recurse
ENDPOINT = r"""https?://[^\s"'<>]++|(?<![A-Za-z0-9_.-])(?=[a-z0-9-]++\.)[a-z0-9.-]++(?<=[a-z0-9]):[0-9]{2,5}\b"""
ASSIGN_VALUE = 8
#: what stands before the value of an assignment
_BEFORE_VALUE = r"""^(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: characters between parts of one scope, and the stretch of text by which the interval joins are dealt
SCOPE = 256
STRETCH = 512
_RUN = 512

SPANS = "array<struct<s:int,k:int,e:int>>"


def _bind(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def running_sums(values: Column) -> Column:
    """The sums of an int array's prefixes; in runs of _RUN, so that long arrays are not copied for each element."""
    ints = F.array().cast("array<int>")

    def inner(run: Column, base: Column) -> Column:
        zero = F.struct(base.alias("t"), ints.alias("o"))
        return F.aggregate(run, zero, lambda a, v: F.struct((a.t + v).alias("t"), F.concat(a.o, F.array(a.t + v)).alias("o")))

    def outer(held: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(held) - 1) / _RUN).cast("int")), lambda r: F.slice(held, r * _RUN + 1, _RUN))
        zero = F.struct(F.lit(0).alias("t"), F.array().cast("array<array<int>>").alias("o"))
        all_runs = F.aggregate(runs, zero, lambda a, run: _bind(inner(run, a.t), lambda i: F.struct(i.t.alias("t"), F.concat(a.o, F.array(i.o)).alias("o"))))
        return F.when(F.size(held) > 0, F.flatten(all_runs.o)).otherwise(ints)

    return _bind(values, outer)


def matches(text: Column, pattern: str, kind: int, value: tuple[str, int] | None = None) -> Column:
    """Spans of a pattern's leftmost non-overlapping matches; value: (what stands before a match's value, characters
    that the value needs). A text without a match is searched once, one with matches three times."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))

    def spans(found: Column) -> Column:
        ends = running_sums(F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, h: g + F.length(h)))
        out = F.zip_with(ends, found, lambda e, h: F.struct((e - F.length(h)).alias("s"), F.lit(kind).alias("k"), e.alias("e"), h.alias("h")))
        if value is not None:
            out = F.filter(out, lambda x: F.length(F.regexp_replace(x.h, F.lit(value[0]), F.lit(""))) >= value[1])
        return F.transform(out, lambda x: F.struct(x.s.alias("s"), x.k.alias("k"), x.e.alias("e")))

    return F.when(text.rlike(pattern), _bind(hits, spans)).otherwise(F.array().cast(SPANS)).cast(SPANS)


def render(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x.k + 1), x.s, x.e)), ",")


def found_spans(docs: DataFrame) -> DataFrame:
    """row, doc_id, base and weak spans of every row of docs."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t, none = F.col("text"), F.array().cast(SPANS)
    base = rows.select("doc_id", "text", matches(t, ASSIGN, 0, (_BEFORE_VALUE, ASSIGN_VALUE)).alias("assign"), matches(t, ACCESS, 1).alias("access"), matches(t, HEX, 2).alias("hex"), matches(t, IDENT, 3).alias("ident"))
    # without an identifier no weak part can be linked, and the text is not searched for them
    known = (F.size("access") > 0) | (F.size("ident") > 0)
    weak = F.concat("ident", F.when(known, matches(t, SECRET, 4)).otherwise(none), F.when(known, matches(t, ENDPOINT, 5)).otherwise(none))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return base.select(F.monotonically_increasing_id().alias("row"), "doc_id", *counts, F.concat("assign", "access", "hex").alias("base"), weak.alias("weak"))


def linked_spans(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row and span of the weak parts that have their complementary parts in scope."""
    some = found.where(F.size("weak") > 0)
    parts = some.select("row", F.explode(F.concat("base", "weak")).alias("p")).select("row", "p.s", "p.k", "p.e")
    ident, secret = F.col("k").isin(1, 3), F.col("k").isin(0, 2, 4)

    def dealt(df: DataFrame, reach: int, names: str = "") -> DataFrame:
        lo, hi = F.greatest(F.col("s") - reach, F.lit(0)), F.col("e") + reach
        cells = F.explode(F.sequence(F.floor(lo / STRETCH), F.floor(hi / STRETCH)))
        out = df.select("row", "s", "k", "e", cells.alias("cell"))
        return out.select("row", "cell", *(F.col(c).alias(f"{names}{c}") for c in ("s", "k", "e")))

    def partnered(these: DataFrame, others: DataFrame) -> DataFrame:
        """Those whose interval, widened by the scope, overlaps one of the others."""
        a, b = dealt(these, scope), dealt(others, 0, "o")
        near = (a.row == b.row) & (a.cell == b.cell) & (a.s - scope < b.oe) & (b.os < a.e + scope)
        return a.join(b, near, "left_semi").select("row", "s", "k", "e").distinct()

    weak_secret = partnered(parts.where("k = 4"), parts.where(ident))
    weak_ident = partnered(parts.where("k = 3"), parts.where(secret))
    endpoint = partnered(partnered(parts.where("k = 5"), parts.where(ident)), parts.where(secret))
    return weak_secret.union(weak_ident).union(endpoint)


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row for each row of docs: doc_id, n_assign, n_access, n_hex, base and spans (arrays of s, k, e; k indexes KINDS)."""
    stages = Stages(docs.sparkSession, "secrets")
    found = stages.write(found_spans(docs), "found")
    linked = linked_spans(found, scope).groupBy("row").agg(F.collect_list(F.struct("s", "k", "e")).alias("linked"))
    joined = found.join(linked, "row", "left")
    return joined.select("doc_id", "n_assign", "n_access", "n_hex", "base", F.concat("base", F.coalesce("linked", F.array().cast(SPANS))).alias("spans"))
