"""Token counts by a map-side two-tier lookup (operator 4).

A text's number of tokens is the sum over its pre-tokens of the number of
tokens of each. The first tier is a broadcast hash table of the corpus's
frequent pre-tokens and their lengths, at most ``TABLE_ENTRIES`` of at most
``TABLE_LENGTH`` characters. What it lacks is encoded by the tokenizer's
merges and kept in a cache of the worker, within a bound; so is the sum over
each stretch between two spaces that is cut the same in every text. No pre-token is
shuffled to be counted: only each task's summary of its most frequent ones is
added up to choose the table. The table's contents decide the speed, never
the counts.

Special tokens inside a text count one each, as the library's default has it.

Defined cases: a null text is empty and has no tokens; a very long pre-token
is encoded but not cached; repeated rows each get a row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cardsight.llm.common import python_on

#: Fixed value: how byte-level models cut a text into pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

TABLE_ENTRIES = 65_536
TABLE_LENGTH = 32
#: Entries of a task's summary, and how many of them it passes on.
SUMMARY_ENTRIES = 200_000
SUMMARY_SENT = 8_192
CACHE_ENTRIES = 400_000


class Spec(NamedTuple):
    """A tokenizer file's text, its special tokens and digest; a fixed size."""

    text: str
    special: list[str]
    digest: str


def read_tokenizer(path: str) -> Spec:
    """Read a tokenizer file on the driver; raises if it is not a plain byte-level one."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    pre = spec["pre_tokenizer"] or {}
    plain_special = all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
    if any(" " in t["content"] for t in spec["added_tokens"]):
        raise ValueError("special tokens with spaces are not built here")
    if pre.get("type") != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"] or not plain_special:
        raise ValueError("only byte-level tokenizers without normalization are built here")
    special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    return Spec(text, special, hashlib.sha256(text.encode()).hexdigest())


def byte_letters() -> list[str]:
    """The letter that byte-level models write for each byte: itself where it
    prints, else the next letter from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b], extra = chr(extra), extra + 1
    return letters


class Pretokens:
    """Cuts texts into pre-tokens and counts the special tokens between them."""

    def __init__(self, spec: Spec):
        self.find = regex.compile(PRE_TOKEN).findall
        self.special = regex.compile("|".join(map(regex.escape, spec.special))) if spec.special else None

    def __call__(self, text: str) -> tuple[list[str], int]:
        if self.special is None or not self.special.search(text):
            return self.find(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.find(part)], len(parts) - 1

    def alone(self, chunk: str) -> bool:
        """Whether ``chunk``, found between two spaces, is cut the same in every
        text: its pre-tokens touch no white space beside these spaces, and it
        holds no special token."""
        return bool(chunk) and not (chunk[0].isspace() or chunk[-1].isspace() or (self.special and self.special.search(chunk)))


class Lengths(dict):
    """Pre-token -> tokens: the broadcast table, then the worker's cache, then the merges."""

    def __init__(self, spec: Spec, table: dict[str, int] | None = None):
        super().__init__(table or {})
        self.cache: dict[str, int] = {}
        self.merges = Tokenizer.from_str(spec.text).model
        self.letters = byte_letters()

    def __missing__(self, pretoken: str) -> int:
        n = self.cache.get(pretoken)
        if n is None:
            letters = self.letters
            n = len(self.merges.tokenize("".join([letters[b] for b in pretoken.encode()])))
            if len(pretoken) <= TABLE_LENGTH:
                if len(self.cache) >= CACHE_ENTRIES:
                    self.cache.clear()
                self.cache[pretoken] = n
        return n


#: More tokens than any text has: marks a chunk whose cut depends on its neighbours.
DEPENDS = 1 << 60


class Chunks(dict):
    """Tokens of a space and the chunk after it: a worker's cache over the pre-tokens' lengths."""

    def __init__(self, cut: Pretokens, lengths: Lengths):
        super().__init__()
        self.cut, self.lengths = cut, lengths

    def __missing__(self, chunk: str) -> int:
        if not self.cut.alone(chunk):
            return DEPENDS
        n = sum(map(self.lengths.__getitem__, self.cut.find(" " + chunk)))
        if len(chunk) <= TABLE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[chunk] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a text."""
        head, *chunks = text.split(" ")
        n = sum(map(self.__getitem__, chunks))
        if n < DEPENDS and self.cut.alone(head):
            return n + sum(map(self.lengths.__getitem__, self.cut.find(head)))
        pretokens, special = self.cut(text)
        return sum(map(self.lengths.__getitem__, pretokens)) + special


_CHUNKS: dict[tuple[str, int], Chunks] = {}


def frequent_lengths(texts: DataFrame, spec: Spec, entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """The first tier: token counts of the corpus's frequent pre-tokens, at most ``entries``."""

    def summarize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, chunks = Pretokens(spec), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                chunks.update(t.split(" "))
                if len(chunks) > SUMMARY_ENTRIES:
                    chunks = Counter(dict(chunks.most_common(SUMMARY_ENTRIES // 2)))
        seen: Counter[str] = Counter()
        for chunk, n in chunks.items():
            if len(chunk) <= TABLE_LENGTH and cut.alone(chunk):
                for p in cut.find(" " + chunk):
                    seen[p] += n
        top = seen.most_common(SUMMARY_SENT)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["pretoken", "n"]
        )

    rows = (
        texts.mapInArrow(summarize, "pretoken string, n long")
        .groupBy("pretoken").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "pretoken").limit(entries)
        .collect()
    )
    lengths = Lengths(spec)
    return {r["pretoken"]: lengths[r["pretoken"]] for r in rows}


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens``, one row per row of ``docs``."""
    spark = docs.sparkSession
    python_on(spark)
    spec = read_tokenizer(tokenizer_path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    shared = spark.sparkContext.broadcast((spec, frequent_lengths(docs.select(text), spec)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, table = shared.value
        key = (spec.digest, len(table))
        if key not in _CHUNKS:
            _CHUNKS.clear()
            _CHUNKS[key] = Chunks(Pretokens(spec), Lengths(spec, table))
        count = _CHUNKS[key].count
        for batch in batches:
            counts = [count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text)
    return rows.mapInArrow(run, "id long, n_bytes long, n_tokens long")
