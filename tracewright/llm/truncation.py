"""Problem 4: texts cut off by field limits or broken transfers.

Longer copies first.  Exact ones: texts that share their first (or last) characters are range sorted, and a
text that is a prefix (or suffix) of the next one and stops (or starts) inside its sentence is cut.  Near
ones: texts are banded on min-hashes of their five-word runs, candidate pairs are verified exactly
(similarity 0.8 or more) and aligned at the shorter text's closing (or opening) words; the copy whose
alignment ends early is cut.  Unmatched texts are scored by terminality: how often a closing word or line,
seen anywhere in texts of its kind, closes a text or a line, and the same for openings.  A log's last line
that is built like whole lines of other logs says nothing, so such a log counts as whole unless its length
is a field limit or texts that open as it does nearly always have a closing.  Counts are taken over all
distinct texts (a text counts once, however often it is copied) and stay distributed; they meet the texts
by joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.runs import WordHasher, mix64, rolling
from tracewright.llm.textkit import visible
from tracewright.session import clean_label, durable, table

#: Marks that a tool or viewer leaves where it cut a text.
MARKS = ["[truncated]", "[...]", "[…]", "(output truncated)", "(truncated)", "<truncated>", "…", "�"]
_CLOSED = regex.compile(r"[.!?。！？]['\"”’»)\]`*_>]*$")
_VERSION = regex.compile(r"(?:^|\s)[\"'(`]*v?\d+\.$")
_SPAN_OPEN = regex.compile(r"(?:^|[\s(\"'])`[^`]*$")
_FENCE_OPEN = regex.compile(r"^```\w")
_SOFT = regex.compile(r"(?:\.\.\.|…)\s*$")
_CAMEL = regex.compile(r"^[A-Z]?[a-z]+[A-Z]\w*$|^[A-Z][a-z]+[A-Z]")
_DIGITS = regex.compile(r"\d+")
_IDENT = regex.compile(r"[\w./\-]*[/_][\w./\-]*|\p{Lu}\p{Ll}+\p{Lu}\w*|\d+(?:\.\d+)*")
_LIST = regex.compile(r"^(?:[-*+•]|\d+[.)])\s")
EXTENSION = regex.compile(r"\.(\w+)([^\w]*)$")
_CODE_ONLY = regex.compile(r"^(?:`[^`\n]+`|\x60{3}.*\x60{3})$", regex.S)
_LAST_RUN = re.compile(r"(?:[^\W\d_]+|\d+)(?=[\W_]*$)")
LOG_KINDS = frozenset({"tool", "stderr"})
#: Exact copies: a prefix or suffix proves nothing unless so many characters agree.
HEAD_CHARS = 40
#: Near copies: five-word runs, similarity of 0.8 or more, eight bands of two min-hashes.
RUN_WORDS, SIMILAR, BANDS, BAND_ROWS = 5, 0.8, 8, 2
#: A field limit is a length that so many texts of a kind share, and so many times more than lengths near it.
LIMIT_LEAST, LIMIT_TIMES, LIMIT_NEAR = 12, 12.0, 10
#: A closing or opening is typical of logs if so many of the kind's texts have it.
TYPICAL = 0.025
#: Logs that open alike are framed if such a share of them has a typical closing.
FRAMED = 0.9
#: A pattern or opening that a smaller share of the kind's texts has is no evidence that prose is whole.
FEW = 0.0005


def _mask(token: str, cache: dict[str, str]) -> str:
    got = cache.get(token)
    if got is None:
        core = token.strip("\"'`()[]{}<>,;:.=!?")
        tail = token[len(token.rstrip("\"'`()[]{}<>,;:.=!?")) :]
        if "/" in token:
            ext = EXTENSION.search(core)
            got = "P" + (f".{ext[1].casefold()}" if ext else "") + tail
        elif "_" in core or "-" in core or _CAMEL.search(core):
            got = "I" + tail
        else:
            got = _DIGITS.sub("N", token.casefold())
        if len(cache) > 200_000:
            cache.clear()
        cache[token] = got
    return got


def _opening(text: str, cache: dict[str, str]) -> str:
    parts = text.split(None, 2)
    if parts and "一" <= parts[0][0] <= "鿿":
        return parts[0][:2]
    return " ".join(_mask(p, cache) for p in parts[:2])


class _Counter:
    """n_any, n_first and n_last of keys, given out, hashed, when a bound is reached."""

    def __init__(self, most: int = 300_000):
        self.most, self.at = most, {}

    def add(self, key: str, first: int = 0, last: int = 0) -> None:
        got = self.at.get(key)
        if got is None:
            self.at[key] = [1, first, last]
        else:
            got[0] += 1
            got[1] += first
            got[2] += last


_FIELDS = "tag tinyint, rec_id bigint, item_no int, kind string, size int, end_state tinyint, end_key bigint, start_state tinyint, start_key bigint, whole_key bigint, head bigint, tail bigint, text_key bigint, line_key bigint, run_key bigint, bands array<bigint>, n_any bigint, n_first bigint, n_last bigint"
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]
_TYPES = [pa.int8(), pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int8(), pa.int64(), pa.int8(), *[pa.int64()] * 7, pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]


def _bands(words: list[np.ndarray]) -> pa.Array:
    """Keys of the bands of min-hashes of each text's five-word runs; none for texts of fewer words."""
    size = np.array([max(0, len(w) - RUN_WORDS + 1) for w in words], dtype=np.int64)
    some = np.flatnonzero(size)
    keys = np.empty((len(some), BANDS), dtype=np.uint64)
    if len(some):
        begin = np.cumsum([0, *map(len, words)])[:-1][some]
        start = np.cumsum(size[some]) - size[some]
        flat = rolling(np.concatenate(words), RUN_WORDS)[np.repeat(begin - start, size[some]) + np.arange(size.sum())]  # runs within one text
        for b in range(BANDS):
            key = np.full(len(some), b + 1, dtype=np.uint64)
            for r in range(BAND_ROWS):
                salt = mix64(np.uint64([b * BAND_ROWS + r + 1]))[0]
                key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + np.minimum.reduceat(mix64(flat ^ salt), start))
            keys[:, b] = key
    ends = np.cumsum(np.concatenate(([0], np.where(size > 0, BANDS, 0)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64)))


def _features(texts: DataFrame) -> DataFrame:
    """Rows of tag 0: the closing and opening of each text; rows of tag 1: counts of keys.

    States: 0 whole, 1 cut, 2 to be decided by the key's counts, 3 by the whole text's pattern alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        cache: dict[str, str] = {}
        counts = _Counter()
        hasher = WordHasher()

        def name(key: str) -> int:
            return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass")) - (1 << 63)

        def flush() -> pa.RecordBatch:
            keys = [name(k) for k in counts.at]
            v = list(counts.at.values())
            counts.at = {}
            none = [None] * len(keys)
            cols = [[1] * len(keys), *[none] * 5, keys, *[none] * 9, [x[0] for x in v], [x[1] for x in v], [x[2] for x in v]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)

        for batch in batches:
            out: list[list] = []
            hashed: list[np.ndarray] = []
            for rec, item, kind, text in zip(*(c.to_pylist() for c in batch.columns)):
                bare = text.strip()
                if not visible(bare):
                    continue
                low = bare.casefold()
                hashed.append(hasher(low.split()))
                lines = bare.split("\n")
                last_line = lines[-1]
                marked = any(bare.endswith(m) for m in MARKS) or bare.startswith("�")
                if kind in LOG_KINDS:
                    end_key = start_key = line_key = run_key = 0
                    n = len(lines)
                    for k, line in enumerate(lines):
                        parts = line.split()
                        if not parts:
                            continue
                        a = _mask(parts[0], cache)
                        closing = f"c\x1f{kind}\x1f{a}\x1f{_mask(parts[-1], cache)}\x1f{len(parts)}"
                        counts.add(closing, 0, int(k == n - 1))
                        begun = f"f\x1f{kind}\x1f{a}"
                        counts.add(begun)
                        last = _LAST_RUN.search(parts[-1])
                        run = "" if last is None else "N" if last[0].isdigit() else last[0].casefold()
                        run = f"v\x1f{kind}\x1f{run}"
                        if k == n - 1:
                            end_key, line_key, run_key = name(closing), name(begun), name(run)
                        else:
                            counts.add(run)  # words that close whole lines
                        second = _mask(parts[1], cache) if len(parts) > 1 else ""
                        opening = f"o\x1f{kind}\x1f{'P' if a[:2] == 'P.' else a}\x1f{'P' if second[:2] == 'P.' else second}"
                        counts.add(opening, int(k == 0), 0)
                        if k == 0:
                            start_key = name(opening)
                    end_state, start_state, whole = (1 if marked else 2), 2, 0  # logs are judged by lines, not by whole patterns
                else:
                    open_fence = bool(bare.count("```") % 2) and not bare.endswith("```") and (_FENCE_OPEN.search(bare[bare.rindex("```") :]) is not None or not _CLOSED.search(last_line))
                    whole = line_key = run_key = 0
                    item_line = bool(_LIST.match(last_line))
                    last = _mask(last_line.rsplit(None, 1)[-1], cache)
                    closing = f"c\x1f{kind}\x1f{'l' if item_line else 'p'}\x1f{last}"
                    end_key = name(closing)
                    if marked or open_fence:
                        end_state = 1
                    elif _CODE_ONLY.search(bare):
                        end_state = 0
                    elif _CLOSED.search(last_line) and not _SOFT.search(last_line):
                        end_state = 1 if _VERSION.search(last_line) and not item_line else 0
                    elif _SPAN_OPEN.search(last_line):
                        end_state = 1
                    elif bare.endswith("```") or (last_line.endswith((")", "]", ">")) and last_line.count("(") == last_line.count(")")):
                        end_state = 0
                    elif item_line:
                        end_state = 2
                    else:
                        end_state = 3
                        whole = name(f"w\x1f{kind}\x1f{_IDENT.sub('X', low)}")  # texts of equal patterns end alike
                    for line in lines[:-1]:
                        if _LIST.match(line):
                            counts.add(f"c\x1f{kind}\x1fl\x1f{_mask(line.rsplit(None, 1)[-1], cache)}", 0, 1)
                    if item_line:
                        counts.add(closing, 0, 0)
                    opening = f"o\x1fprose\x1f{_opening(low, cache)}"
                    start_key = name(opening)
                    counts.add(opening, 1, 0)
                    first = bare[0]
                    if not first.isalpha() or first.isupper() or "一" <= first <= "鿿":
                        start_state = 0
                    elif low == bare:
                        start_state = 2
                    else:
                        start_state = 1
                head, tail = (name("h" + low[:HEAD_CHARS]), name("t" + low[-HEAD_CHARS:])) if len(low) >= HEAD_CHARS else (None, None)
                out.append([0, rec, item, kind, len(text), end_state, end_key, start_state, start_key, whole, head, tail, name("t\x1f" + bare), line_key, run_key, None, None, None, None])
            if out:
                cols = [list(c) for c in zip(*out)]
                cols[15] = _bands(hashed)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)
            if len(counts.at) > counts.most:
                yield flush()
        if counts.at:
            yield flush()

    return texts.where("text is not null").select("rec_id", "item_no", "kind", "text").mapInArrow(run, _FIELDS)


def _limits(judged: DataFrame) -> DataFrame:
    """kind, size: field limits, lengths that stand out and whose texts are cut for the most part; copies
    of a text count once."""
    sizes = judged.groupBy("kind", "size", "text_key").agg(F.bool_or("cut").alias("cut")).groupBy("kind", "size").agg(F.count(F.lit(1)).alias("n"), F.count_if("cut").alias("n_cut"))
    some = sizes.where((F.col("n") >= LIMIT_LEAST) & (2 * F.col("n_cut") > F.col("n")))
    near = some.select("kind", F.col("size").alias("limit"), F.explode(F.sequence(F.col("size") - LIMIT_NEAR, F.col("size") + LIMIT_NEAR)).alias("size")).where("size <> limit")
    around = near.join(sizes.select("kind", "size", F.col("n").alias("m")), ["kind", "size"]).groupBy("kind", F.col("limit").alias("size")).agg(F.sum("m").alias("around"))
    spiking = some.join(around, ["kind", "size"], "left").where(F.col("n") >= LIMIT_TIMES * F.coalesce(F.col("around"), F.lit(0)) / (2 * LIMIT_NEAR))
    return spiking.select("kind", "size", F.lit(True).alias("at_limit"))


def _ends(texts: DataFrame, features: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """The texts that copies are sought for: those whose first or last characters several different texts
    share (with these keys), and those of near-copy pairs.  All texts are shuffled for it, once.

    features may say with ``may_end`` and ``may_start`` which texts are undecided; buckets without any are left out."""
    flag = lambda name: F.bool_or(F.col(name) if name in features.columns else F.lit(True)).alias(name)
    one_each = features.groupBy("text_key").agg(F.min("rec_id").alias("rec_id"), F.first("head").alias("head"), F.first("tail").alias("tail"), flag("may_end"), flag("may_start"))
    for sketch, may in (("head", "may_end"), ("tail", "may_start")):
        shared = one_each.where(F.col(sketch).isNotNull()).groupBy(sketch).agg(F.count(F.lit(1)).alias(f"{sketch}_n"), F.bool_or(may).alias("asked")).where(f"asked and {sketch}_n > 1").drop("asked")
        one_each = one_each.join(shared, sketch, "left")
    wanted = one_each.where("head_n is not null or tail_n is not null").select("rec_id", "text_key", "head", "tail", "head_n", "tail_n")
    if pairs is not None:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("rec_id")).distinct()
        wanted = wanted.unionByName(ids, allowMissingColumns=True).groupBy("rec_id").agg(*[F.max(c).alias(c) for c in wanted.columns[1:]])
    return durable(texts.select("rec_id", F.regexp_replace("text", r"^\s+|\s+$", "").alias("text")).join(wanted, "rec_id"))


def _prefixes(ends: DataFrame) -> DataFrame:
    """text_key, mark (early or late): texts that a longer text shows to end, or begin, inside a sentence.

    They are range sorted, so a bucket of any size spreads over tasks; a text that is a prefix of others
    stands right before one of them; the last of a part meets the first of the next.  Suffixes: the same
    on reversed texts."""
    edge, kinds = ["part", "at", "sketch", "text_key", "sorted"], [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    out = None
    for sketch, mark, turn in (("head", "early", False), ("tail", "late", True)):
        one = ends.where(f"{sketch}_n is not null").select(sketch, "text_key", (F.reverse("text") if turn else F.col("text")).alias("sorted"))
        parts = one.repartitionByRange(sketch, "sorted").sortWithinPartitions(sketch, "sorted")

        def hits(rows: list[tuple], turn: bool) -> list[int]:
            return [a[1] for a, b in zip(rows, rows[1:]) if a[0] == b[0] and len(b[2]) > len(a[2]) and b[2].startswith(a[2]) and _inside(a[2], b[2], turn)]

        def run(batches: Iterator[pa.RecordBatch], turn=turn) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            first: tuple | None = None
            last: tuple | None = None
            for batch in batches:
                rows = list(zip(*(c.to_pylist() for c in batch.columns)))
                if not rows:
                    continue
                hit = hits([last, *rows] if last else rows, turn)
                first, last = first or rows[0], rows[-1]
                none = [None] * len(hit)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((none, none, none, hit, none), kinds)], names=edge)
            if first:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(([part, part], [0, 1], *zip(first, last)), kinds)], names=edge)

        def meet(batches: Iterator[pa.RecordBatch], turn=turn) -> Iterator[pa.RecordBatch]:
            last: tuple | None = None
            for batch in batches:
                hit: list[int] = []
                for _, at, *row in zip(*(c.to_pylist() for c in batch.columns)):
                    if at == 0 and last:
                        hit.extend(hits([last, row], turn))
                    last = row
                yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64())], names=["text_key"])

        made = durable(parts.mapInArrow(run, "part int, at int, sketch bigint, text_key bigint, sorted string"))
        edges = made.where("part is not null").repartition(1).sortWithinPartitions("part", "at")  # two rows for each part
        found = made.where("part is null").select("text_key").unionByName(edges.mapInArrow(meet, "text_key bigint")).withColumn("mark", F.lit(mark))
        out = found if out is None else out.unionByName(found)
    return out


def _near_pairs(features: DataFrame) -> DataFrame:
    """a, b, key_a: candidates for near-copies, texts of two or more equal band keys, each pair once, a the
    shorter.  Of pairs of just the wanted similarity 0.995 have two.

    features: rows with ``open``, whether the text's end or beginning is undecided; only such a text is
    looked up."""
    keyed = features.where("size(bands) > 0").select("rec_id", "text_key", "size", "open", F.explode("bands").alias("band"))
    short = keyed.where("open").select(F.col("rec_id").alias("a"), F.col("text_key").alias("key_a"), F.col("size").alias("size_a"), "band")
    long = keyed.select(F.col("rec_id").alias("b"), F.col("text_key").alias("key_b"), F.col("size").alias("size_b"), "band")
    return durable(short.join(long, "band").where("size_a < size_b and key_a <> key_b").groupBy("a", "b", "key_a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))


def _near_aligned(ends: DataFrame, pairs: DataFrame) -> DataFrame:
    """text_key, mark (early or late): the same for near-copies, texts with edits elsewhere.

    A pair must reach the similarity on its sets of five-word runs; then the shorter text's last six words
    are looked up in the longer one, the last of them as a part of a word."""
    bare = ends.select("rec_id", "text")
    left = pairs.join(bare.select(F.col("rec_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(bare.select(F.col("rec_id").alias("b"), F.col("text").alias("text_b")), "b").select("key_a", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            keys, marks = [], []
            for key, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                for mark in _alignment(a, b, hasher):
                    keys.append(key)
                    marks.append(mark)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(marks, pa.string())], names=["text_key", "mark"])

    return both.mapInArrow(run, "text_key bigint, mark string")


def _aligned(texts: DataFrame, features: DataFrame) -> DataFrame:
    """rec_id, item_no, early, late: what exact copies show."""
    return features.select("rec_id", "item_no", "text_key").join(_by_side(_prefixes(_ends(texts, features))), "text_key").drop("text_key")


def _by_side(marks: DataFrame) -> DataFrame:
    return marks.groupBy("text_key").agg(F.bool_or(F.col("mark") == "early").alias("early"), F.bool_or(F.col("mark") == "late").alias("late"))


def _alignment(short: str, long: str, hasher: WordHasher) -> Iterator[str]:
    """early and late, if the two texts are alike and the shorter one stops, or starts, inside a sentence of the longer."""
    x, y = (np.unique(rolling(hasher(t.casefold().split()), RUN_WORDS)) for t in (short, long))
    both = len(np.intersect1d(x, y, assume_unique=True))
    if both < SIMILAR * (len(x) + len(y) - both):
        return
    for mark, turn in (("early", False), ("late", True)):
        a, b = (short[::-1], long[::-1]) if turn else (short, long)
        words = a.split()
        closing = words[-RUN_WORDS - 1 :]
        at = regex.compile(r"\s+".join(map(regex.escape, closing))).search(b)
        if at and at.end() < len(b) and _inside(a, a + b[at.end() : at.end() + 2], turn):
            yield mark


def _inside(short: str, long: str, turned: bool) -> bool:
    """Whether the longer copy goes on within the sentence in which the shorter one stops."""
    after = long[len(short) : len(short) + 2]
    if turned:
        return not (after[0] == "\n" or (after[0].isspace() and after[1:] in {".", "!", "?", "\n", " ", ""}) or after[0] in "。！？")
    last = short[-1]
    if after[0] == "\n" or last in "。！？":
        return False
    return not (last in ".!?" and after[0].isspace())


def cut_texts(texts: DataFrame) -> DataFrame:
    """rec_id, item_no, kind, cut_start, cut_end of every visible text (rec_id, item_no, kind, text).

    kind names what the text is (user, assistant, tool, stderr); counts are kept by kind.  Null and blank
    texts are in no row; equal texts get equal answers; an empty table gives none."""
    rows = texts.where("text is not null").select("rec_id", "item_no", "kind", F.xxhash64("kind", "text").alias("copy"), "text")
    one = durable(rows.groupBy(F.col("copy").alias("rec_id")).agg(F.first("kind").alias("kind"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")).withColumn("item_no", F.lit(0)))
    judged = _judged(one).select(F.col("rec_id").alias("copy"), "cut_start", "cut_end")
    return rows.drop("text").join(judged, "copy").select("rec_id", "item_no", "kind", "cut_start", "cut_end")


def _judged(texts: DataFrame) -> DataFrame:
    """rec_id, cut_start, cut_end of texts of which each is there once, with the number of its ``copies``."""
    made = durable(_features(texts))
    features = made.where("tag = 0").select("rec_id", "item_no", "kind", "size", "end_state", "end_key", "start_state", "start_key", "whole_key", "head", "tail", "text_key", "line_key", "run_key", "bands")
    counts = durable(made.where("tag = 1").groupBy(F.col("end_key").alias("key")).agg(F.sum("n_any").alias("n_any"), F.sum("n_first").alias("n_first"), F.sum("n_last").alias("n_last")))
    distinct = features.select("kind", "end_key", "start_key", "whole_key", "text_key").distinct()
    same = texts.select("rec_id", "copies")
    kinds = features.join(same, "rec_id").groupBy("kind").agg(F.count_distinct("text_key").alias("n_texts"), F.sum("copies").alias("n_rows"))
    closes = distinct.groupBy(F.col("end_key")).agg(F.count(F.lit(1)).alias("end_texts"))
    opens = distinct.groupBy(F.col("start_key")).agg(F.count(F.lit(1)).alias("start_texts"))
    wholes = distinct.where("whole_key <> 0").groupBy("whole_key").agg(F.count(F.lit(1)).alias("whole_texts"))
    end_counts = counts.select(F.col("key").alias("end_key"), F.col("n_any").alias("end_any"), F.col("n_last").alias("end_last"))
    start_counts = counts.select(F.col("key").alias("start_key"), F.col("n_any").alias("start_any"), F.col("n_first").alias("start_first"))
    line_counts = counts.select(F.col("key").alias("line_key"), F.col("n_any").alias("line_any"))
    run_counts = counts.select(F.col("key").alias("run_key"), F.col("n_any").alias("run_any"))
    x = features.drop("head", "tail", "bands").join(line_counts, "line_key", "left").join(run_counts, "run_key", "left")
    x = x.join(end_counts.join(closes, "end_key"), "end_key", "left").join(start_counts.join(opens, "start_key"), "start_key", "left")
    x = x.join(wholes, "whole_key", "left").join(same, "rec_id").join(F.broadcast(kinds), "kind")  # a row for each kind
    log = F.col("kind").isin(*LOG_KINDS)
    typical = F.greatest(F.lit(2.0), TYPICAL * F.col("n_texts"))
    c = lambda name: F.coalesce(F.col(name), F.lit(0))
    inner = c("start_any") - c("start_first")
    seen_inside = inner >= F.greatest(F.lit(2.0), 0.2 * TYPICAL * F.col("n_texts"))
    stock = F.col("copies") >= F.greatest(F.lit(3.0), TYPICAL * F.col("n_rows"))
    # Many copies speak for a whole log only if its last line closes logs and lines begun alike mostly end so too.
    stock_end = stock & (c("end_last") >= 0.5 * c("end_any")) & (c("line_any") < 2 * c("end_any"))
    few, few_opened = F.greatest(F.lit(3.0), FEW * F.col("n_texts")), F.greatest(F.lit(2.0), FEW * F.col("n_texts"))
    closing = (c("end_texts") >= typical) & (c("end_last") >= 0.5 * c("end_any"))
    broken = (c("end_any") <= c("end_last")) | (c("run_any") == 0)  # no whole line is built so, or ends in this word
    end_prose = F.when(F.col("end_state") == 3, c("whole_texts") < few).otherwise((c("end_any") < 3) | (c("end_last") < 0.2 * c("end_any")))
    cut_end = F.when(F.col("end_state") == 1, True).when(log & (stock_end | closing), False).when(log, broken).when(F.col("end_state") == 0, False).otherwise(end_prose)
    start_log = (~seen_inside & ~(c("start_texts") >= typical)) | (seen_inside & (c("start_first") < 0.02 * c("start_any")))
    start_prose = (F.col("start_state") == 1) & (c("start_texts") < few_opened)
    cut_start = F.when(log & stock & ~seen_inside, False).when(log, start_log).otherwise(start_prose)
    # What a field limit makes a cut: prose with a closing sign, a log without a typical closing.
    limited = F.when(log, ~closing & ~stock_end).otherwise(F.col("end_state") == 0)
    closed_end = F.when(log, closing | stock_end).otherwise(F.col("end_state") == 0)
    closed_start = F.when(log, c("start_texts") >= typical).otherwise(F.col("start_state") == 0)
    open_ = ~(cut_start | cut_end) & ~(closed_end & closed_start)
    prose_start = ~log & (F.col("start_state") == 0)  # prose that begins with a capital or in Chinese may have been quoted whole behind a few words
    decided = durable(x.select("rec_id", "kind", "size", "text_key", "start_key", open_.alias("open"), (log & closing).alias("closing"), (log & ~closing & ~stock_end).alias("unclosed"), limited.alias("limited"), closed_end.alias("closed_end"), closed_start.alias("closed_start"), prose_start.alias("prose_start"), typical.alias("typical"), cut_start.alias("cut_start"), cut_end.alias("cut_end")))
    asked = decided.select("rec_id", "open", (~F.col("cut_end") & ~F.col("closing")).alias("may_end"), (~F.col("cut_start") & ~F.col("prose_start") & ~(F.col("closed_start") & F.col("kind").isin(*LOG_KINDS))).alias("may_start"))
    shapes = features.select("rec_id", "text_key", "size", "bands", "head", "tail").join(asked, "rec_id")
    pairs = _near_pairs(shapes)
    ends = _ends(texts, shapes, pairs)
    exact, near = (_by_side(m).select("text_key", F.col("early").alias(f"{n}_early"), F.col("late").alias(f"{n}_late")) for n, m in (("exact", _prefixes(ends)), ("near", _near_aligned(ends, pairs))))
    t = lambda name: F.coalesce(F.col(name), F.lit(False))
    shown = decided.join(exact, "text_key", "left").join(near, "text_key", "left")
    shown = shown.withColumn("cut_end", F.col("cut_end") | t("exact_early") | (t("near_early") & ~F.col("closed_end")))
    judged = durable(shown.withColumn("cut_start", F.col("cut_start") | (t("exact_late") & ~F.col("prose_start")) | (t("near_late") & ~F.col("closed_start"))).drop("exact_early", "exact_late", "near_early", "near_late"))
    framed = judged.where("closing or unclosed").groupBy("start_key").agg(F.count(F.lit(1)).alias("n"), F.count_if("closing").alias("n_closing"), F.max("typical").alias("typical")).where((F.col("n") >= F.col("typical")) & (F.col("n_closing") >= FRAMED * F.col("n"))).select("start_key", F.lit(True).alias("framed"))
    limits = _limits(judged.withColumn("cut", F.col("cut_start") | F.col("cut_end")))
    full = judged.join(limits, ["kind", "size"], "left").join(framed, "start_key", "left")
    more = (F.col("limited") & F.coalesce("at_limit", F.lit(False))) | (F.col("unclosed") & F.coalesce("framed", F.lit(False)))
    return full.select("rec_id", "cut_start", (F.col("cut_end") | more).alias("cut_end"))


def message_texts(sessions: DataFrame, record: str, roles: tuple = ("user", "assistant", "tool")) -> DataFrame:
    role = F.lower(F.trim(F.col("m.role")))
    return sessions.select(F.col(record).cast("bigint").alias("rec_id"), F.posexplode("messages").alias("item_no", "m")).select("rec_id", "item_no", role.alias("kind"), F.col("m.content").alias("text")).where(F.col("kind").isin(*roles) & F.col("text").isNotNull())


def stderr_texts(runs: DataFrame) -> DataFrame:
    return runs.select(F.col("run_id").cast("bigint").alias("rec_id"), F.posexplode("problem_pack.problems").alias("item_no", "p")).select("rec_id", "item_no", F.lit("stderr").alias("kind"), F.col("p.stderr").alias("text")).where("text is not null")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that lost their beginning or end."""
    texts = message_texts(table(spark, sf_dir, "sft_dataset"), "sample_id").unionByName(stderr_texts(table(spark, sf_dir, "fullbench_latest")))
    return cut_texts(texts).where("cut_start or cut_end").select("rec_id", "item_no").distinct()


def p4_truncation_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source (of messages) or model (of stderr) truncates."""
    sft, runs = table(spark, sf_dir, "sft_dataset"), table(spark, sf_dir, "fullbench_latest")
    cut = cut_texts(message_texts(sft, "sample_id").unionByName(stderr_texts(runs)))
    label = sft.select(F.col("sample_id").alias("rec_id"), clean_label(F.col("source")).alias("label")).unionByName(runs.select(F.col("run_id").alias("rec_id"), clean_label(F.col("model")).alias("label")))
    return cut.join(label, "rec_id").groupBy("label", "kind").agg(F.count(F.lit(1)).alias("n_texts"), F.count_if("cut_start").alias("n_cut_start"), F.count_if("cut_end").alias("n_cut_end"), F.round(F.avg(F.expr("cast(cut_start or cut_end as double)")), 6).alias("rate"))


QUERIES = {"p4_found": p4_found, "p4_truncation_rates": p4_truncation_rates}
