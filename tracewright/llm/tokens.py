"""Problem 1: token budgets under an existing byte-level BPE vocabulary.

A text is pre-split into pieces by the vocabulary's pattern.  The distinct pieces of an Arrow batch
are stored as one flat array of symbol ids with piece offsets; in each round every adjacent pair is
joined with the table of merge ranks (a sorted-key lookup), each piece applies all occurrences of its
lowest-ranked merge, and pieces without a known pair leave the working set.  Rounds repeat until none
is left; the symbols of a piece are then its tokens.  Pieces beyond ``LONG_PIECE`` bytes (unbroken
strings) use the same merges driven by a heap, so their cost is n log n.

The stage is narrow: no text is shuffled, only (slice, count) pairs after partial aggregation.
The merge table is broadcast; its size is a property of the vocabulary file and is checked.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm.textkit import language
from tracewright.session import clean_label, ensure_small, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: The pre-split pattern of this family of byte-level vocabularies (a fixed value).
PRESPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_PIECE = 256
#: A worker forgets its piece counts when it holds this many.
CACHE_PIECES = 400_000


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte value in such vocabularies: itself, or 256 onwards."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {b: chr(b) for b in kept}
    for n, b in enumerate(b for b in range(256) if b not in stand_in):
        stand_in[b] = chr(256 + n)
    return [stand_in[b] for b in range(256)]


class MergeTable:
    """Byte ids and the merges as sorted arrays: pair key, rank, id of the merged symbol."""

    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, merges = model["vocab"], model["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        key = (left << 32) | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.merged = key[order], order.astype(np.int32), merged[order]
        self.byte_id = np.array([vocab[c] for c in _byte_letters()], dtype=np.int32)
        self._dict: dict[tuple[int, int], tuple[int, int]] | None = None

    @property
    def nbytes(self) -> int:
        return self.key.nbytes + self.rank.nbytes + self.merged.nbytes

    def _lookup(self, key: np.ndarray) -> np.ndarray:
        """Position of each pair key in the merge table, -1 where there is no such merge."""
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == key, at, -1)

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Number of tokens of each piece."""
        counts = np.zeros(len(pieces), dtype=np.int64)
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for k in np.flatnonzero(length > LONG_PIECE):
            counts[k] = self._count_long(pieces[k])
        live = np.flatnonzero((length <= LONG_PIECE) & (length > 0))
        if not len(live):
            return counts
        symbol = self.byte_id[np.frombuffer(b"".join([pieces[k] for k in live]), dtype=np.uint8)]
        size = length[live]
        nowhere = np.int32(np.iinfo(np.int32).max)
        while len(live):
            start = np.concatenate(([0], np.cumsum(size)[:-1]))
            at = self._lookup((symbol[:-1].astype(np.int64) << 32) | symbol[1:])
            at = np.append(at, -1)
            at[start + size - 1] = -1  # the last symbol of a piece begins no pair
            rank = np.where(at >= 0, self.rank[at], nowhere)
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == nowhere
            counts[live[done]] = size[done]
            apply = rank == np.repeat(np.where(done, np.int32(-1), lowest), size)
            hit = np.flatnonzero(apply)
            if len(hit) > 1:  # in a run of overlapping hits every other one, from the left
                new_run = np.concatenate(([True], np.diff(hit) != 1))
                first = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
            owner = np.repeat(np.arange(len(live)), size)
            symbol[hit] = self.merged[at[hit]]
            keep = np.repeat(~done, size)
            keep[hit + 1] = False
            size = (size - np.bincount(owner[hit], minlength=len(live)))[~done]
            symbol, live = symbol[keep], live[~done]
        return counts

    def _count_long(self, piece: bytes) -> int:
        if self._dict is None:
            self._dict = {(int(k >> 32), int(k & 0xFFFFFFFF)): (int(r), int(m)) for k, r, m in zip(self.key, self.rank, self.merged)}
        merges = self._dict
        sym = self.byte_id[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p][0], i, p) for i in range(n - 1) if (p := (sym[i], sym[i + 1])) in merges]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = nxt[i] if sym[i] >= 0 else n
            if j >= n or (sym[i], sym[j]) != pair:
                continue
            sym[i], sym[j] = merges[pair][1], -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            left -= 1
            for a in (prv[i], i):
                b = nxt[a] if a >= 0 else n
                if b < n and (p := (sym[a], sym[b])) in merges:
                    heapq.heappush(heap, (merges[p][0], a, p))
        return left


class TokenCounter:
    """Counts tokens of texts; keeps the counts of the pieces it has met."""

    def __init__(self, merges: MergeTable):
        self.merges, self.split, self.known = merges, regex.compile(PRESPLIT), {}

    def __call__(self, texts: Iterable[str | None]) -> list[int]:
        split, known = self.split.findall, self.known
        pieces = [split(t) if t else () for t in texts]
        if len(known) > CACHE_PIECES:
            known.clear()
        fresh = list(set().union(*pieces).difference(known))
        if fresh:
            # a lone surrogate half has no UTF-8 form and counts as the replacement sign
            known.update(zip(fresh, self.merges.count([p.encode("utf-8", "replace") for p in fresh]).tolist()))
        get = known.__getitem__
        return [sum(map(get, p)) for p in pieces]


_shared: dict[tuple[int, str], object] = {}


def merge_broadcast(spark: SparkSession, path: str = VOCABULARY):
    """The merge table on every executor, loaded once for a session; a vocabulary bounds its size."""
    key = (id(spark.sparkContext), path)
    if key not in _shared:
        merges = MergeTable(path)
        ensure_small(merges.nbytes, "merge table")
        _shared[key] = spark.sparkContext.broadcast(merges)
    return _shared[key]


def with_token_counts(df: DataFrame, text: str, keep: list[str], vocabulary: str = VOCABULARY, with_language: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens of the text column (a string or an array of strings counted one by
    one) and, if asked, the language of the text.  A null or empty text has 0 tokens and language null.
    """
    shared = merge_broadcast(df.sparkSession, vocabulary)
    is_array = dict(df.dtypes)[text].startswith("array")
    source = df.select(*keep, F.col(text).alias("__text"))
    schema = source.drop("__text").schema.add("n_tokens", "long")
    if with_language:
        schema = schema.add("text_lang", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(shared.value)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            rows = column.to_pylist()
            if is_array:
                flat = [t for r in rows if r for t in r]
                each = np.concatenate(([0], np.cumsum(counter(flat)))) if flat else np.zeros(1, dtype=np.int64)
                ends = np.cumsum([len(r) if r else 0 for r in rows])
                begins = ends - [len(r) if r else 0 for r in rows]
                counts = each[ends] - each[begins] if len(rows) else []
            else:
                counts = counter(rows)
            out = [*batch.columns[:-1], pa.array(counts, pa.int64())]
            if with_language:
                out.append(pa.array([language(t if not is_array else "\n".join(x for x in t or () if x)) for t in rows], pa.string()))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return source.mapInArrow(run, schema)


def language_label(col: Column) -> Column:
    """The two-letter code that a language label stands for; null where it names none of the five."""
    base = F.regexp_extract(F.lower(F.trim(col)), r"^([a-z]+)", 1)
    named = {"en": ["en", "eng", "english"], "de": ["de", "ger", "deu", "german"], "es": ["es", "spa", "spanish"], "fr": ["fr", "fra", "fre", "french"], "zh": ["zh", "chi", "zho", "chinese"]}
    out = F.lit(None).cast("string")
    for code, spellings in named.items():
        out = F.when(base.isin(spellings), F.lit(code)).otherwise(out)
    return out


def model_label(col: Column) -> Column:
    """A model name without case, outer spacing and routing prefixes."""
    return clean_label(F.regexp_replace(F.lower(F.trim(col)), r"^((openrouter|local)/)+", ""))


def session_strings(messages: Column) -> Column:
    """Every string of a session that a model reads: contents, reasoning, call names and arguments."""
    calls = lambda m: F.flatten(F.transform(F.coalesce(m["tool_calls"], F.array()), lambda c: F.array(c["function"]["name"], c["function"]["arguments"])))
    parts = F.flatten(F.transform(messages, lambda m: F.concat(F.array(m["content"], m["reasoning_content"]), calls(m))))
    return F.filter(parts, lambda s: s.isNotNull() & (s != ""))


def document_tokens(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """collection, id, source, model, lang, domain, n_tokens for each document; labels cleaned, the
    language read from the text and only where the text tells none from its label."""
    base = documents.select(F.col("doc_id").alias("id"), clean_label(F.col("source")).alias("source"), language_label(F.col("lang")).alias("label"), clean_label(F.col("doc_kind")).alias("domain"), "text")
    counted = with_token_counts(base, "text", ["id", "source", "label", "domain"], vocabulary, with_language=True)
    return counted.select(F.lit("documents").alias("collection"), "id", "source", F.lit("none").alias("model"), F.coalesce("text_lang", "label", F.lit("unknown")).alias("lang"), "domain", "n_tokens")


def session_tokens(sessions: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The same for sessions of messages; a null or empty session has 0 tokens."""
    base = sessions.select(F.col("sample_id").alias("id"), clean_label(F.col("source")).alias("source"), model_label(F.col("model")).alias("model"), clean_label(F.col("task_type")).alias("domain"), session_strings(F.col("messages")).alias("strings"))
    counted = with_token_counts(base, "strings", ["id", "source", "model", "domain"], vocabulary, with_language=True)
    return counted.select(F.lit("sft_dataset").alias("collection"), "id", "source", "model", F.coalesce("text_lang", F.lit("unknown")).alias("lang"), "domain", "n_tokens")


def token_budget(tokens: DataFrame) -> DataFrame:
    """Totals by source and model, by language, by domain and over all, one grouping-sets pass.

    Columns that a row does not group by hold 'all'.  An empty input gives no slices."""
    keys = ["collection", "source", "model", "lang", "domain"]
    base = tokens.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"), F.sum("n_tokens").alias("n_tokens"))
    sets = [keys, ["collection", "source", "model"], ["collection", "source"], ["collection", "lang"], ["collection", "domain"], ["collection"]]
    grouped = base.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(F.sum("n_records").alias("n_records"), F.sum("n_tokens").alias("n_tokens"), *[F.grouping(c).alias(f"__{c}") for c in keys[1:]])
    return grouped.select("collection", *[F.when(F.col(f"__{c}") == 1, F.lit("all")).otherwise(F.col(c)).alias(c) for c in keys[1:]], "n_records", "n_tokens")


def p1_token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_budget(document_tokens(table(spark, sf_dir, "documents")).unionByName(session_tokens(table(spark, sf_dir, "sft_dataset"))))


def p1_record_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_tokens(table(spark, sf_dir, "documents")).unionByName(session_tokens(table(spark, sf_dir, "sft_dataset")))


QUERIES = {"p1_token_budget": p1_token_budget, "p1_record_tokens": p1_record_tokens}
