"""Personal data, also where it is disguised, with spans in code points of the original text.

Plain identifiers are found in the text itself. Then transducers rewrite what hides identifiers - look-alike letters and
full-width forms, spelled digits, at/dot disguises - while they keep, for each written character, the source span it
comes from. Identifiers found in the rewritten text are mapped back and added if they touch a rewritten place and no plain
identifier.

Edge cases: null is an empty text. Spans of one kind never overlap, those of different kinds may. Repeated rows are
treated each; extra columns pass through, and what is found lies in the column SPANS. All scans take time in proportion
to the text (times the logarithm of the number of spans): no pattern starts anew inside a run that it has failed on.

What counts as a disguise is bounded: at most three spaces on either side of a bracketed sign and of its bracket; one space
around a bare "at" or "dot"; one to three spaces or dashes between spelled digits; words that announce an address right
before it, within CUE_CHARS characters. Wider ones are not taken for disguises.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import tuned, unused

SPANS = "__pii"
KINDS = ("email", "ip", "card", "phone")
SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGIT = re.compile(r"[0-9]")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Letters of other scripts that look like ASCII letters, and other forms of signs.
LOOK_ALIKE = dict(
    zip(
        "аеорсухіјѕһԁАВЕКМНОРСТХІЈЅοανιρΑΒΕΖΗΙΚΜΝΟΡΤΥΧ。․‐‑‒–",
        "aeopcyxijshdABEKMHOPCTXIJSoavipABEZHIKMNOPTYX..----",
    )
)
#: Characters that show nothing.
INVISIBLE = frozenset("­​‌‍⁠﻿")
FULL_WIDTH = range(0xFF01, 0xFF5F)
HIDING = re.compile("[­Ͱ-ϿЀ-ԯ​-‍‐-–․⁠。﻿！-～]")
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_DIGIT_WORD = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine|[0-9])"
SPELLED = re.compile(rf"(?i)(?<![^\W_])(?:plus[\x20-]+)?{_DIGIT_WORD}(?:[\x20-]{{1,3}}{_DIGIT_WORD}){{6,}}(?![^\W_])")
_PART = rf"(?:{_DIGIT_WORD}(?:[\x20-]{_DIGIT_WORD}){{0,2}}|[0-9]{{1,3}})"
SPELLED_IP = re.compile(rf"(?i)(?<![^\W_]){_PART}(?:\x20(?:dot|point)\x20{_PART}){{3}}(?![^\W_])")
SIGNS = re.compile(r"(?i)[\x20]{0,3}[\[({<][\x20]{0,3}(at|@|dot|\.)[\x20]{0,3}[\])}>][\x20]{0,3}")
AT = re.compile(r"(?i)\x20at\x20|@")
HOST_PARTS = re.compile(r"(?i)[A-Za-z0-9-]++(?:(?:\x20dot\x20|\.)[A-Za-z0-9-]++)*+")
PART_END = re.compile(r"(?i)\x20dot\x20|\.")
BARE_SIGN = re.compile(r"(?i)\x20(at|dot)\x20")
TOP_LEVEL = re.compile(r"[A-Za-z]{2,24}\Z")
#: Words that announce an address.
CUE = re.compile(r"(?i)(?:\bmail|\bcontact|\bwrite\x20to|\breach|\baddress|\baddress\x20is)[:,]?\x20(?:(?:to|me|us|is)\x20)?\Z")
CUE_CHARS = 24


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain(text: str) -> list[tuple[str, int, int]]:
    """The identifiers as they stand: (kind, start, end), by kind as listed and start."""
    found: list[tuple[str, int, int]] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := HOST.match(text, at + 1)):
            found.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if not DIGIT.search(text):
        return found
    for m in DOTTED.finditer(text):
        start, parts = m.start(), m.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            end = start + sum(map(len, parts[k : k + 4])) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in parts[k : k + 4]):
                found.append(("ip", start, end))
            start = end + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return found


class Rewritten:
    """A text and, for each character, the source span it stands for and whether it was rewritten."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends, self.new = text, None, None, None

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans of the present text (in order, apart) with other text."""
        import numpy as np

        if not edits:
            return
        if self.starts is None:
            self.starts, self.ends, self.new = np.arange(len(self.text)), np.arange(1, len(self.text) + 1), np.zeros(len(self.text), dtype=bool)
        texts, starts, ends, new, at = [], [], [], [], 0
        for a, b, to in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[at:a], to]
            starts += [self.starts[at:a], np.full(len(to), self.starts[a] if a < b else 0)]
            ends += [self.ends[at:a], np.full(len(to), self.ends[b - 1] if a < b else 0)]
            new += [self.new[at:a], np.ones(len(to), dtype=bool)]
            at = b
        self.text, self.starts, self.ends, self.new = "".join(texts), np.concatenate(starts), np.concatenate(ends), np.concatenate(new)


def _look_alikes(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in HIDING.finditer(text):
        c = m.group()
        to = "" if c in INVISIBLE else chr(ord(c) - 0xFEE0) if ord(c) in FULL_WIDTH else LOOK_ALIKE.get(c)
        if to is not None:
            edits.append((m.start(), m.end(), to))
    return edits


def _spelled(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in SPELLED.finditer(text):
        parts = re.split(r"[\x20-]+", m.group().lower())
        digits = "".join(DIGIT_WORDS.get(x, x) for x in parts if x != "plus")
        if any(x in DIGIT_WORDS for x in parts):
            edits.append((*m.span(), ("+" if parts[0] == "plus" or (len(digits) < 13 and text[max(0, m.start() - 1) : m.start()] != "+") else "") + digits))
    return edits


def _spelled_ip(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in SPELLED_IP.finditer(text):
        parts = [re.split(r"[\x20-]+", x) for x in re.split(r"\x20(?:dot|point)\x20", m.group().lower())]
        edits.append((*m.span(), ".".join("".join(DIGIT_WORDS.get(x, x) for x in p) for p in parts)))
    return edits


def _signs(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), "@" if m[1].lower() in ("at", "@") else ".") for m in SIGNS.finditer(text)]


def _bare_signs(text: str) -> list[tuple[int, int, str]]:
    """Signs of addresses such as jane dot doe at example dot com, or jane.doe at example.com.

    From each at, the name is read to the left and the host to the right, so each place is read twice at most. Some dot has
    to be spelled, or the name has to look like one (a digit or a sign in it, or a word before it that announces an address).
    """
    edits, free = [], 0
    for m in AT.finditer(text):
        if m.start() < free:
            continue
        start = m.start()
        while True:
            at = start
            while at > free and text[at - 1] in LOCAL:
                at -= 1
            if at == start:
                break
            start = at
            if start - 5 >= free and text[start - 5 : start].lower() == " dot " and text[start - 6 : start - 5] in LOCAL:
                start -= 5
            else:
                break
        host = HOST_PARTS.match(text, m.end())
        if start == m.start() or not host:
            continue
        end, ends = host.end(), [x.span() for x in PART_END.finditer(text, host.start(), host.end())]
        while ends and not TOP_LEVEL.match(text[ends[-1][1] : end]):
            end = ends.pop()[0]
        if not ends:
            continue
        name, written = text[start : m.start()], text[start:end]
        spelled = BARE_SIGN.search(text, m.end() - 1, end + 1) or " dot " in name.lower()
        named = m.group() != "@" and (any(c in "0123456789._%+-" for c in name.strip(".")) or CUE.search(text[max(0, start - CUE_CHARS) : start]))
        if spelled or named:
            edits += [(start + s.start(), start + s.end(), "@" if s[1].lower() == "at" else ".") for s in BARE_SIGN.finditer(written)]
            free = end
    return edits


def disguised(text: str) -> list[tuple[str, int, int]]:
    """What only the rewritten text shows, as spans of the original."""
    r = Rewritten(text)
    if not text.isascii() and HIDING.search(text):
        r.apply(_look_alikes(text))
    low = r.text.lower()
    if any(x in low for x in DIGIT_WORDS):
        r.apply(_spelled(r.text))
    if " dot " in low or " point " in low:
        r.apply(_spelled_ip(r.text))
    if any(x in low for x in ("[", "(", "{", "<")) and any(x in low for x in ("at", "@", "dot")):
        r.apply(_signs(r.text))
    if " dot " in low or " at " in low:
        r.apply(_bare_signs(r.text))
    if r.new is None:
        return []
    # A removed character leaves no trace in the new text but a gap in its sources.
    found = []
    for kind, a, b in plain(r.text):
        start, end = int(r.starts[a]), int(r.ends[b - 1])
        if r.new[a:b].any() or end - start != b - a:
            found.append((kind, start, end))
    return found


def spans_of(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by kind as listed and start."""
    text = text or ""
    base = plain(text)
    starts, ends = [], []  # of what base spans cover, without overlaps
    for _, a, b in sorted(base, key=lambda x: x[1]):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)

    def over(a: int, b: int) -> bool:
        k = bisect_left(starts, b) - 1
        return k >= 0 and ends[k] > a

    extra = [(k, a, b) for k, a, b in disguised(text) if not over(a, b)]
    every = [(*x, True) for x in base] + [(*x, False) for x in dict.fromkeys(extra)]
    return sorted(every, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


def masked(text: str | None, spans: list[tuple[str, int, int, bool]]) -> str | None:
    """The text with a mark such as [EMAIL] for each span; of overlapping ones, for the first."""
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def found(docs: DataFrame, mask: bool = False, name: str = SPANS) -> DataFrame:
    """docs with the spans in a column of this name; with mask, identifiers in text are replaced by marks."""
    tuned(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            columns, texts = list(batch.columns), batch.column(at).to_pylist()
            spans = [spans_of(x) for x in texts]
            if mask:
                columns[at] = pa.array([masked(x, s) for x, s in zip(texts, spans)], type=columns[at].type)
            rows = [[{"kind": k, "start": a, "end": b, "base": c} for k, a, b, c in s] for s in spans]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, type=kind)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, SPAN_TYPE)]))


def joined(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    rows = found(docs.select("doc_id", "text")).drop("text")
    base = F.filter(SPANS, lambda x: x["base"])
    count = lambda kind: F.size(F.filter(SPANS, lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")
    counts = [count(k) for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col(SPANS)).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with identifiers masked and all columns of theirs; n_chars, where present and known, follows the new text."""
    (spans,) = unused(docs, SPANS)
    out = found(docs, mask=True, name=spans).drop(spans)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
