"""Secrets in text: known formats, and strings that pass a battery of randomness tests.

The battery looks at strings of LEAST or more letters, digits and - _ + / that no
known format covers, = at their end included: of name=value, name and value are
strings of their own, and so is each part that a known format leaves uncovered.
Strings of a single class of characters (digits, upper case, lower case, others)
are not tested.  Each of the rest is taken as hexadecimal, base32, alphabetic,
alphanumeric or base64 by its characters and gets three tests: how even its characters are
over the alphabet (chi-squared), how often its character classes change (runs),
and how much neighbours resemble each other (serial correlation).  Their joined
statistic becomes a p-value by its distribution over strings that are written and
not random (`written`: words, names, numbers, dates and versions, drawn with a
fixed seed), in each stratum of encoding and length: by rank up to the 95th
percentile, by an exponential tail beyond it.  The p-values are controlled for
false discoveries (Benjamini-Hochberg) over the whole corpus, by stratum, as a
short string can prove less.

Scale: one map over all rows, no text is shuffled; p-values are counted in bins
for each stratum (BINS x strata rows at most, whatever the corpus) to find the
thresholds, which are broadcast; so is what is known of written strings, some
hundred numbers a stratum.

Cases: null is an empty text and has no spans; texts are never cut; rows that
repeat count as often as they stand there; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = 20
PART = re.compile(r"[A-Za-z0-9_+/-]+")
FIRST, JOINS = re.compile(r"[A-Z](?=[a-z])"), re.compile(r"[_+/-]+")
RATE, BINS = 0.01, 64
#: Written strings drawn for a stratum; longer strings than LONGEST are tested in windows of so many characters.
DRAWN, LONGEST = 600, 128
#: alphabet size and pattern, tried in order
ENCODINGS = (("hex", 16, re.compile(r"[0-9a-f]+|[0-9A-F]+")), ("base32", 32, re.compile(r"[A-Z2-7]+=*")), ("alpha", 52, re.compile(r"[A-Za-z]+")), ("alnum", 62, re.compile(r"[A-Za-z0-9]+")), ("base64", 64, re.compile(r"[A-Za-z0-9_+/-]+=*")))


@cache
def _long(least: int) -> re.Pattern:
    return re.compile(rf"[A-Za-z0-9_+/=-]{{{least},}}")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the known formats, in order of start, then assign, access, hex."""
    found = [(m.start(), m.end(), 0, "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), 1, "access") for m in ACCESS.finditer(text)] if "AKIA" in text else []
    found += [(m.start(), m.end(), 2, "hex") for m in HEX.finditer(text)]
    return [(s, e, k) for s, e, _, k in sorted(found, key=lambda x: (x[0], x[2]))]


def candidates(text: str, spans: list[tuple[int, int, str]], least: int = LEAST) -> Iterator[tuple[int, int]]:
    """(start, end) of the strings to test: = only ends one, and none reaches into the spans of known formats."""
    for m in _long(least).finditer(text):
        start, stop = m.span()
        gaps = []
        for s, e, _ in sorted(x for x in spans if x[0] < stop and start < x[1]):
            gaps.append((start, s))
            start = max(start, e)
        for a, z in [*gaps, (start, stop)]:
            for part in PART.finditer(text, a, max(a, z)):
                end = part.end()
                while end < z and text[end] == "=":
                    end += 1
                if PART.match(text, end):  # = between name and value
                    end = part.end()
                if end - part.start() >= least:
                    yield part.start(), end


def tail(z: float) -> float:
    """P(N > z)."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def statistic(s: str) -> tuple[str, float] | None:
    """Encoding and joined statistic of one string, higher for random ones; None if it is of no encoding or shows a single class of characters.

    A long string is as random as the least random of its windows, the last of which ends where it ends.
    """
    kind, size = next(((n, k) for n, k, p in ENCODINGS if p.fullmatch(s)), (None, 0))
    s = s.rstrip("=")
    if not kind:
        return None
    if len(s) <= LONGEST:
        found = joined(s, size)
    else:
        parts = [joined(s[at : at + LONGEST], size) for at in [*range(0, len(s) - LONGEST, LONGEST), len(s) - LONGEST]]
        found = min(x or 0.0 for x in parts) if any(x is not None for x in parts) else None
    return None if found is None else (kind, found)


def joined(s: str, size: int) -> float | None:
    """The three tests of one string over an alphabet of this size, as minus the sum of the logarithms of their p-values; None for a single class of characters."""
    classes = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in s]
    if len(set(classes)) < 2:
        return None
    n = len(s)
    counts = Counter(s)
    # written text: a few characters carry most of it; the even string has chi-squared near size - 1
    chi = sum(c * c for c in counts.values()) * size / n - n
    even = tail((n * 0.045 * size - n + size - 1 - chi) / math.sqrt(2 * (size - 1) + 4 * n * 0.02 * size))
    share = [v / n for v in Counter(classes).values()]
    changes = sum(a != b for a, b in zip(classes, classes[1:]))  # noqa: B905
    differ = 1 - sum(x * x for x in share)
    if "d" not in classes:  # names of many words: a word's first capital and what joins words are no change
        case = [c.isupper() for c in FIRST.sub("a", JOINS.sub("", s))]
        changes = sum(a != b for a, b in zip(case, case[1:]))  # noqa: B905
    # written text changes class rarely: a tenth of its places
    runs = tail((changes - 0.1 * (n - 1)) / math.sqrt((n - 1) * 0.09)) if differ else 1.0
    values = [ord(c) for c in s]
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values) or 1.0
    serial = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / var  # noqa: B905
    # clear correlation, as in numbered or repeated strings, speaks for written text
    independent = tail((0.5 - abs(serial)) * math.sqrt(n))
    return -sum(math.log(max(p, 1e-300)) for p in (even, runs, independent))


_VOWELS, _CONSONANTS = "eeeeaaaiiioouu", "ttttnnnnssshhrrrddlllcmmfwgpybvk"


def _word(rng: random.Random, longest: int = 9) -> str:
    n, first = rng.randint(2, longest), rng.random() < 0.7
    return "".join(rng.choice(_CONSONANTS if (k % 2 == 0) == first and rng.random() < 0.9 else _VOWELS) for k in range(n))


def _number(rng: random.Random) -> str:
    """A count, a padded number, a date, a time, a version or a year."""
    k = rng.randrange(6)
    date = f"20{rng.randrange(10, 30)}{rng.randrange(1, 13):02d}{rng.randrange(1, 29):02d}"
    return (str(rng.randrange(1, 100)), f"{rng.randrange(1, 10_000):06d}", date, date + f"{rng.randrange(24):02d}{rng.randrange(60):02d}{rng.randrange(60):02d}", f"v{rng.randrange(1, 20)}", date[:4])[k]


def written(rng: random.Random, kind: str, n: int) -> str:
    """A string of n characters of this encoding such as people and programs write: names, numbered names, dates, padded numbers."""
    style, parts, size = rng.randrange(4), [], 0
    dated = rng.random() < 0.15
    while size < n:
        number = kind != "alpha" and rng.random() < (0.7 if dated or kind == "hex" else 0.25)
        if kind == "hex":
            part = rng.choice(("facade", "decade", "added", "bead", "cafe", "dead", "beef", "face", "feed")) if not number else "".join(c for c in _number(rng) if c.isdigit())
        elif kind == "base32":
            part = "".join(c for c in _number(rng) if c in "234567") if number else _word(rng).upper()
        else:
            part = _number(rng) if number else _word(rng)
            part = part.capitalize() if style == 1 else part.upper() if style == 2 and rng.random() < 0.8 else part
        if kind == "base64":
            part = ("-" if dated else "/" if style == 3 else rng.choice("_-")) + part
        parts.append(part)
        size += len(part)
    return "".join(parts)[-n:]


def stratum(kind: str, length: int) -> str:
    length = min(length, LONGEST)
    return f"{kind}:{length.bit_length() * 2 + (length >> max(length.bit_length() - 2, 0) & 1)}"


@cache
def written_strings(least: int = LEAST) -> dict[str, tuple[list[float], float, float]]:
    """For each stratum the sorted statistics of written strings, their 95th percentile, and the mean excess over it."""
    out: dict[str, list[float]] = {}
    rng = random.Random(20240229)
    lengths: dict[str, list[int]] = {}
    for n in range(least, LONGEST + 1):
        lengths.setdefault(stratum("", n), []).append(n)
    for kind, _, _ in ENCODINGS:
        for some in lengths.values():
            for _ in range(DRAWN):
                found = statistic(written(rng, kind, rng.choice(some)))
                if found and found[0] == kind:
                    out.setdefault(stratum(kind, some[0]), []).append(found[1])
    known = {}
    for name, x in out.items():
        if len(x) < 100:
            continue
        x.sort()
        high = x[int(0.95 * len(x))]
        over = [v - high for v in x if v > high]
        known[name] = (x[:: max(len(x) // 200, 1)], high, max(sum(over) / max(len(over), 1), 0.5))
    return known


def battery(s: str, known: dict[str, tuple[list[float], float, float]] | None = None) -> tuple[str, float] | None:
    """Stratum and p-value of one string under the hypothesis that it is written; None if it is not tested."""
    found = statistic(s)
    if not found:
        return None
    known = written_strings() if known is None else known
    name = stratum(found[0], len(s))
    if name not in known:  # too few written strings are of this encoding and length: those of base64 stand for them
        name_known = stratum("base64", len(s))
    else:
        name_known = name
    ranks, high, excess = known[name_known]
    if found[1] > high:
        return name, 0.05 * math.exp(-(found[1] - high) / excess)
    return name, max(0.05, 1 - bisect.bisect_left(ranks, found[1]) / len(ranks))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, base (spans of known formats) and tested (candidates with stratum and bin of -log10 p) of each row."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    span = "array<struct<start:int,end:int,kind:string>>"
    known = written_strings(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
        two = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("stratum", pa.string()), ("bin", pa.int32())])
        for b in batches:
            base, tested = [], []
            for x in b.column("text"):
                t = x.as_py() or ""
                spans = base_spans(t)
                base.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
                found = []
                for s, e in candidates(t, spans, least):
                    if got := battery(t[s:e], known):
                        found.append({"start": s, "end": e, "stratum": got[0], "bin": min(int(-4 * math.log10(max(got[1], 1e-300))), BINS - 1)})
                tested.append(found)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(base, pa.list_(one)), pa.array(tested, pa.list_(two))], names=["doc_id", "base", "tested"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base {span}, tested array<struct<start:int,end:int,stratum:string,bin:int>>")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = RATE, least: int = LEAST) -> DataFrame:
    """doc_id, base and spans (base and random ones, in order) of each row; least: the shortest string that is tested."""
    scanned = keep(scan(docs, doc_id, text, least))
    bins = scanned.select(F.explode("tested").alias("x")).groupBy("x.stratum", "x.bin").agg(F.count("*").alias("n"))
    up = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    # Benjamini-Hochberg on bins: the largest p (smallest bin) whose upper end is within rate * rank / tests
    limits = (
        bins.withColumns({"rank": F.sum("n").over(up), "tests": F.sum("n").over(Window.partitionBy("stratum"))})
        .where(F.pow(F.lit(10.0), -F.col("bin") / 4) <= rate * F.col("rank") / F.col("tests"))
        .groupBy("stratum").agg(F.min("bin").alias("least"))
    )
    table = limits.agg(F.map_from_entries(F.collect_list(F.struct("stratum", "least"))).alias("limits"))  # a row of a few dozen strata
    drawn = F.transform(
        F.filter("tested", lambda x: x["bin"] >= F.coalesce(F.try_element_at("limits", x["stratum"]), F.lit(BINS))),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit("random").alias("kind")),
    )
    rank = {"assign": 0, "access": 1, "hex": 2, "random": 3}
    ranked = F.transform(
        F.concat("base", drawn),
        lambda x: F.struct(x["start"].alias("start"), F.create_map(*[F.lit(v) for kv in rank.items() for v in kv])[x["kind"]].alias("rank"), x["end"].alias("end"), x["kind"].alias("kind")),
    )
    return scanned.crossJoin(F.broadcast(table)).select("doc_id", "base", F.sort_array(ranked).alias("spans"))


def as_text(spans: str):
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
