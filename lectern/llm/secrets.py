"""Secrets in texts: three plain patterns, and strings of high entropy.

Spark's regular expressions give the matches of a pattern but not where they start. A text split at the same pattern
gives what lies between; the lengths of both, added up in turn, give the spans (in code points).

The method adds candidates: long runs of key characters with digits and letters. A window slides along each; the entropy
of its characters follows from the last one by the counts of the character that enters and the one that leaves. Each
class of characters has a threshold below what 99% of random strings of it reach; a candidate is cut to the windows above
it. Known harmless forms are suppressed. Of a candidate that overlaps plain matches, the parts outside them are candidates.

The whole path is DataFrame functions: no Python runs on the executors.

All of it takes time in proportion to the text (times the logarithm of the number of matches), and no pattern repeats a group:
Java would take a frame of the stack for each turn.

Edge cases: null is an empty text. A failing match of a pattern is dropped but still takes its characters. Repeated rows
are treated each; extra columns pass through, and what is found lies in one column, with whose name none may begin.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "__secrets"
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as AKIA[A-Z0-9]+ of 20 or more: a shorter run holds no longer one
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"  # as runs of [0-9a-f]+ of 24 or more
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
#: Characters of the sliding window, and the bits a character that a window needs by the class of its string. Random windows
#: of the smallest alphabet that a class may stand for (hex, 32 characters of one case, 62 of both) reach theirs 99 times of 100.
WINDOW, HEX_BITS, ONE_CASE_BITS, BOTH_CASES_BITS, BASE64_BITS = 20, 2.9, 3.34, 3.64, 3.9
GLUE = "/+=_-"
#: Harmless forms: paths and slugs of words; identifiers made of dashes and hex, documentation values, runs of the alphabet.
SLUG, SLUG_PART = f"^[{GLUE}]*[A-Za-z]{{1,19}}[{GLUE}]", "^[A-Za-z]{0,15}[0-9]{0,4}$"
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^[0-9A-Z]?[0-9_/+=-]+[A-Za-z]?$",
    r"(?i)example|sample|placeholder|changeme|your[_-]?(api|key|token|secret)|x{6,}|0123456789|1234567890|abcdefgh",
)


def _let(value: Column, use) -> Column:
    """use(value), where value is computed once although use names it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Elements that a growing array may have before it is laid aside: adding one to an array copies it.
AT_ONCE = 512


def running(values: Column, both) -> Column:
    """Each bigint of an array joined with all before it."""
    none = F.array().cast("array<bigint>")
    zero = F.struct(F.lit(None).cast("bigint").alias("last"), none.alias("some"), F.array().cast("array<array<bigint>>").alias("done"))

    def step(a: Column, v: Column) -> Column:
        new = F.when(a["last"].isNull(), v).otherwise(both(a["last"], v))
        full = F.size(a["some"]) >= AT_ONCE
        return F.struct(
            new.alias("last"),
            F.when(full, F.array(new)).otherwise(F.concat(a["some"], F.array(new))).alias("some"),
            F.when(full, F.concat(a["done"], F.array(a["some"]))).otherwise(a["done"]).alias("done"),
        )

    return F.aggregate(values, zero, step, lambda a: F.flatten(F.concat(a["done"], F.array(a["some"]))))


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """All matches as structs (start, no, end, kind), in order; those whose group is shorter than least are dropped."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    size = lambda a: F.transform(a, lambda x: F.length(x).cast("bigint"))
    # Behind the last match there is one more piece of text, whose length nothing needs.
    parts = F.arrays_zip(F.slice(size(F.split(text, pattern, -1)), 1, F.size(whole)).alias("between"), size(whole).alias("whole"), size(value).alias("value"))
    ends = lambda p: running(F.transform(p, lambda x: x["between"] + x["whole"]), lambda u, v: u + v)
    one = lambda x, end: F.struct((end - x["whole"]).alias("start"), F.lit(KINDS.index(kind)).alias("no"), end.alias("end"), F.lit(kind).alias("kind"))
    placed = _let(parts, lambda p: F.zip_with(p, ends(p), lambda x, end: F.when(x["value"] >= least, one(x, end))))
    none = F.array().cast("array<struct<start:bigint,no:int,end:bigint,kind:string>>")
    return F.when(F.size(whole) > 0, F.filter(placed, lambda x: x.isNotNull())).otherwise(none)


def ranks(points: Column, at: Column, equal: bool) -> Column:
    """For each element of a sorted array how many points of another are smaller (or equal): both are merged and counted."""
    point, asked = (0, 1) if equal else (1, 0)
    rows = F.array_sort(F.concat(F.transform(points, lambda p: F.struct(p.alias("at"), F.lit(point).alias("what"))), F.transform(at, lambda a: F.struct(a.alias("at"), F.lit(asked).alias("what")))))
    counts = lambda m: running(F.transform(m, lambda x: F.when(x["what"] == point, 1).otherwise(0).cast("bigint")), lambda u, v: u + v)
    return _let(rows, lambda m: F.filter(F.zip_with(m, counts(m), lambda x, n: F.when(x["what"] == asked, n)), lambda n: n.isNotNull()))


def dense_part(chars: Column, bits: Column) -> Column:
    """(first, last): 1-based characters from the first to the last window whose entropy is at least bits; 0, 0 for none.

    The entropy of a window of w characters is log2 w - sum(c log2 c) / w over the counts c of its characters. When the
    window moves, only two counts change.
    """
    f = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    count = lambda part, x: F.size(part) - F.size(F.array_remove(part, x))

    def step(a: Column, enters: Column) -> Column:
        i, full = a["i"] + 1, a["i"] >= WINDOW
        leaves = F.get(a["window"], F.lit(0))
        both = F.when(full, F.slice(a["window"], 2, WINDOW - 1)).otherwise(a["window"])

        def moved(part: Column) -> Column:
            gone, come = count(part, leaves), count(part, enters)
            less = F.when(full, F.get(f, gone + 1) - F.get(f, gone)).otherwise(F.lit(0.0))
            return F.struct((a["sum"] - less + F.get(f, come + 1) - F.get(f, come)).alias("sum"), F.concat(part, F.array(enters)).alias("window"))

        def state(new: Column) -> Column:
            high = (i >= WINDOW) & (math.log2(WINDOW) - new["sum"] / WINDOW >= bits)
            return F.struct(i.alias("i"), new["sum"].alias("sum"), F.when(high & (a["first"] == 0), i - WINDOW + 1).otherwise(a["first"]).alias("first"), F.when(high, i).otherwise(a["last"]).alias("last"), new["window"].alias("window"))

        return _let(_let(both, moved), state)

    # The window goes along: a slice of all characters would copy them each time.
    zero = F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("sum"), F.lit(0).alias("first"), F.lit(0).alias("last"), F.array().cast("array<string>").alias("window"))
    return F.aggregate(chars, zero, step)


def found(docs: DataFrame, name: str = SPANS) -> DataFrame:
    """docs with a column of this name, which must be free: plain matches and strings of high entropy, by start and kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    names = [f"`{c}`" for c in docs.columns]
    base, strings, candidates = (f"{name}_{x}" for x in ("base", "strings", "candidates"))
    plain = docs.select(
        *names,
        F.concat(spans(text, ASSIGN, "assign", group=1, least=6), spans(text, ACCESS, "access"), spans(text, HEX, "hex")).alias(base),
        F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias(strings),
    )
    # The strings lie side by side with their spans; both are read twice below, so Catalyst keeps this projection apart.
    held = plain.select(*names, base, F.when(F.size(strings) > 0, F.arrays_zip(spans(text, CANDIDATE, "entropy").alias("span"), F.col(strings).alias("string"))).alias(candidates))
    none_over = F.array().cast("array<struct<start:bigint,no:int,end:bigint,kind:string>>")

    # Plain matches of one kind do not overlap, nor do candidates: those of a kind that lie over a candidate follow one another.
    def over(kind: str) -> Column:
        own = F.filter(base, lambda b: b["kind"] == kind)
        of = lambda field: F.transform(candidates, lambda c: c["span"][field])
        cuts = lambda o: F.arrays_zip(ranks(F.transform(o, lambda b: b["end"]), of("start"), True).alias("low"), ranks(F.transform(o, lambda b: b["start"]), of("end"), False).alias("high"))
        return _let(own, lambda o: F.when(F.size(o) > 0, F.transform(cuts(o), lambda r: F.when(r["low"] < r["high"], F.transform(F.sequence(r["low"].cast("int"), r["high"].cast("int") - 1), lambda k: F.get(o, k))).otherwise(none_over))))

    overs = [f"{name}_over_{k}" for k in KINDS[:3]]
    held = held.select("*", *[F.when(F.size(candidates) > 0, over(k)).alias(o) for k, o in zip(KINDS, overs)])
    # Side by side, not by number: within a function of one candidate, a column might be made anew for each.
    no_lists = F.array().cast("array<array<struct<start:bigint,no:int,end:bigint,kind:string>>>")
    zipped = F.arrays_zip(F.col(candidates).alias("c"), *[F.coalesce(F.col(o), no_lists).alias(f"over{k}") for k, o in enumerate(overs)])
    lists = lambda z: F.array_sort(F.concat(*[F.coalesce(z[f"over{k}"], none_over) for k in range(len(overs))]))
    with_over = F.transform(zipped, lambda z: F.struct(z["c"]["span"].alias("span"), z["c"]["string"].alias("string"), lists(z).alias("over")))
    bits = lambda s: (
        F.when(s.rlike("^[0-9A-Fa-f]+$"), F.lit(HEX_BITS))
        .when(s.rlike(f"^[{GLUE}]*([0-9A-Z]+|[0-9a-z]+)[{GLUE}]*$"), F.lit(ONE_CASE_BITS))
        .when(s.rlike(f"^[{GLUE}]*[0-9A-Za-z]+[{GLUE}]*$"), F.lit(BOTH_CASES_BITS))
        .otherwise(F.lit(BASE64_BITS))
    )

    def apart(c: Column) -> Column:
        """The parts of a candidate outside plain matches, without what glues them to these."""
        first, last, over = c["span"]["start"], c["span"]["end"], c["over"]
        reach = running(F.transform(over, lambda b: b["end"]), lambda u, v: F.greatest(u, v))
        starts = F.concat(F.array(first), F.transform(reach, lambda r: F.greatest(r, first)))
        between = F.filter(F.arrays_zip(starts.alias("start"), F.concat(F.transform(over, lambda b: b["start"]), F.array(last)).alias("end")), lambda p: p["end"] > p["start"])
        # Candidates are ASCII: as bytes, a part is found without counting characters from the beginning.
        part_of = lambda data, start, end: F.substring(data, (start - first + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int")).cast("string")

        def trimmed(data: Column, p: Column) -> Column:
            string = part_of(data, p["start"], p["end"])
            head = F.when(p["start"] > first, F.length(F.regexp_extract(string, f"^[{GLUE}]*", 0))).otherwise(F.lit(0))
            tail = F.when(p["end"] < last, F.length(F.regexp_extract(string, f"(?<![{GLUE}])[{GLUE}]*+$", 0))).otherwise(F.lit(0))
            start, end = p["start"] + head, p["end"] - tail
            return F.struct(F.struct(start.alias("start"), c["span"]["no"].alias("no"), end.alias("end"), c["span"]["kind"].alias("kind")).alias("span"), part_of(data, start, end).alias("string"))

        long_enough = lambda x: (F.length(x["string"]) >= WINDOW) & x["string"].rlike("[0-9]") & x["string"].rlike("[A-Za-z]")
        cut_up = _let(c["string"].cast("binary"), lambda data: F.filter(F.transform(between, lambda p: trimmed(data, p)), long_enough))
        return F.when(F.size(over) == 0, F.array(F.struct(c["span"].alias("span"), c["string"].alias("string")))).otherwise(cut_up)

    def allowed(s: Column) -> Column:
        # A path or slug: a short word, and behind glue only short words with a short number. Cut up, as a repeated group would
        # take a frame of the stack for each turn.
        parts = F.split(F.regexp_replace(s, f"^[{GLUE}]+", ""), f"[{GLUE}]+")
        any_of = s.rlike(SLUG) & F.forall(F.slice(parts, 2, F.size(parts)), lambda p: p.rlike(SLUG_PART))
        for pattern in ALLOWED:
            any_of = any_of | s.rlike(pattern)
        return any_of

    def cut(c: Column) -> Column:
        at = c["span"]["start"]
        part = lambda p: F.struct((at + p["first"] - 1).alias("start"), c["span"]["no"].alias("no"), (at + p["last"]).alias("end"), c["span"]["kind"].alias("kind"))
        return _let(_let(bits(c["string"]), lambda least: _let(F.split(c["string"], ""), lambda chars: dense_part(chars, least))), lambda p: F.when(p["first"] > 0, part(p)))

    left = F.filter(F.flatten(F.transform(with_over, apart)), lambda c: ~allowed(c["string"]))
    high = F.filter(F.transform(left, cut), lambda x: x.isNotNull())
    return held.select(*names, F.sort_array(F.concat(base, F.coalesce(high, F.filter(base, lambda _: F.lit(False))))).alias(name))


def report(docs: DataFrame) -> DataFrame:
    rows = found(docs.select("doc_id", "text")).drop("text")
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter(SPANS, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select("doc_id", *[count(k) for k in KINDS[:3]], F.sha2(joined(F.filter(SPANS, lambda x: x["kind"] != "entropy")).cast("binary"), 256).alias("base_sha256"), joined(F.col(SPANS)).alias("spans"))
