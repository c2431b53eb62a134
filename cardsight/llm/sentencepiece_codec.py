"""SentencePiece BPE encoding and decoding by a prefix table (operator 3).

The tokens of a text are found in one pass from the left. For every prefix the
table stores the last token of that prefix's encoding, which is unique: of the
vocabulary entries that an automaton finds ending here, it is the one that
stands by itself (a prefix of one token) or is compatible with the last token
of the prefix before it. Two tokens are compatible when merging their joined
characters gives just these two. A sequence is the encoding of its text if and
only if all neighbours are compatible: merges are taken by score, the leftmost
of equals first, so the merges inside two neighbouring tokens come in the same
order whatever stands beside them, and the first merge across a border would
show in the pair. The ids are then read backwards from the end of the table.

The text is cut before white space that follows other characters, where no
vocabulary entry spans (checked when the model is read); pieces are cached per
worker, within a bound. Characters in no entry fall back to their bytes.

Defined cases: a null text counts as empty and has the begin and end ids
only; very long texts and words take linear time; repeated rows each get a
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from math import inf
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsight.llm.common import python_on

SPACE = "▁"  # fixed value: the mark for white space in the vocabulary
CACHE_WORDS = 100_000
CACHE_WORD_LENGTH = 48
CACHE_PAIRS = 250_000


class Model(NamedTuple):
    """What encoding needs of a model file; its size is bounded by the vocabulary."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]
    bos: int
    eos: int
    digest: str


def read_model(path: str) -> Model:
    """Read a model file on the driver; raises if it needs what is not built here."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.vocab_size())
    special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in ids]
    byte_ids = [i for i in ids if sp.is_byte(i)]
    pieces = [sp.id_to_piece(i) for i in ids]
    if [pieces[i] for i in byte_ids] != [f"<0x{b:02X}>" for b in range(256)]:
        raise ValueError("the model has no byte fallback")
    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read()).hexdigest()
    model = Model(pieces, [sp.get_score(i) for i in ids], [not x for x in special], byte_ids, sp.bos_id(), sp.eos_id(), digest)
    codec = Encoder(model)
    for probe in (" a  b ", "ﬁ ① é\n\tx", "\U0001f600" + SPACE, "the <s> </s>"):
        if codec.encode(probe) != np.array(sp.encode(probe), "<u4").tobytes():
            raise ValueError("only models without text normalization, with a leading space added, are built here")
    return model


class Encoder:
    """Encoder of one worker. Ids are packed little-endian unsigned 32-bit."""

    def __init__(self, model: Model):
        self.model = model
        entries = [(p, i) for i, (p, n) in enumerate(zip(model.pieces, model.normal)) if n]
        self.rank = {p: -model.scores[i] for p, i in entries}
        self.alphabet = frozenset("".join(self.rank))
        # Tokens by number: the vocabulary, then characters that are only part of longer entries.
        self.tokens = list(model.pieces) + sorted(self.alphabet - self.rank.keys())
        self.packed = [np.array([i], "<u4").tobytes() for i in range(len(model.pieces))]
        self.packed += [self._as_bytes(c) for c in self.tokens[len(model.pieces) :]]
        self.automaton = ahocorasick.Automaton()
        for p, i in entries:
            self.automaton.add_word(p, (i, len(p)))
        for i in range(len(model.pieces), len(self.tokens)):
            self.automaton.add_word(self.tokens[i], (i, 1))
        self.automaton.make_automaton()
        spans = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.rank)
        self.cut = re.compile(f"(?s).+" if spans else f"{SPACE}+[^{SPACE}]*")
        self.words: dict[str, bytes] = {}
        #: For each left token, whether a right one is compatible; ``n_pairs`` in all.
        self.pairs: list[dict[int, bool]] = [{} for _ in self.tokens]
        self.n_pairs = 0
        self.single: dict[int, tuple[bool, list[tuple[float, str, str]]]] = {}

    def _as_bytes(self, char: str) -> bytes:
        return np.array([self.model.byte_ids[b] for b in char.encode()], "<u4").tobytes()

    def _merges(self, token: int) -> tuple[bool, list[tuple[float, str, str]]]:
        """Merging of a token's own characters, best score first, leftmost of
        equals: whether it ends in one piece, and of each merge its rank and
        the first and last piece after it."""
        parts, events = list(self.tokens[token]), []
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, inf) for a, b in zip(parts, parts[1:])]
            best = min(ranks)
            if best == inf:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            events.append((best, parts[0], parts[-1]))
        events.append((inf, "", ""))
        return len(parts) == 1, events

    def _alone(self, token: int) -> tuple[bool, list[tuple[float, str, str]]]:
        known = self.single.get(token)
        if known is None:
            known = self.single[token] = self._merges(token)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of both never crosses their border.

        The merges within either come in the order they have alone, the better
        of the two next ones first, until one across the border is better.
        """
        if self.n_pairs >= CACHE_PAIRS:
            for row in self.pairs:
                row.clear()
            self.n_pairs = 0
        (stands, before), (also, after) = self._alone(left), self._alone(right)
        ok = stands and also
        i = j = 0
        last, first, rank = self.tokens[left][-1], self.tokens[right][0], self.rank
        while ok:
            a, b = before[i][0], after[j][0]
            cross = rank.get(last + first, inf)
            if cross < a and cross <= b and cross < inf:
                ok = False
            elif a == b == inf:
                break
            elif a <= b:
                last, i = before[i][2], i + 1
            else:
                first, j = after[j][1], j + 1
        self.pairs[left][right] = ok
        self.n_pairs += 1
        return ok

    def _tokens_of(self, word: str) -> list[int]:
        """The prefix table of a word of known characters, read backwards."""
        last = [-1] * (len(word) + 1)
        length = [0] * (len(word) + 1)
        pairs = self.pairs
        for end, (token, n) in self.automaton.iter(word):
            end += 1
            if last[end] >= 0:
                continue
            start = end - n
            if start:
                left = last[start]
                ok = pairs[left].get(token)
                if ok is None:
                    ok = self._compatible(left, token)
            else:
                ok = self._alone(token)[0]
            if ok:
                last[end], length[end] = token, n
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= length[at]
        return out[::-1]

    def _word(self, word: str) -> bytes:
        if self.alphabet.issuperset(word):
            ids = b"".join([self.packed[t] for t in self._tokens_of(word)])
        else:
            ids = b""
            for known, run in groupby(word, self.alphabet.__contains__):
                part = "".join(run)
                ids += b"".join([self.packed[t] for t in self._tokens_of(part)]) if known else self._as_bytes(part)
        if len(word) <= CACHE_WORD_LENGTH:
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Packed ids of a text, without begin and end ids."""
        if not text:
            return b""
        get, word = self.words.get, self._word
        return b"".join([get(w) or word(w) for w in self.cut.findall(SPACE + text.replace(" ", SPACE))])


class Decoder:
    """Decoder of one worker."""

    def __init__(self, model: Model):
        self.decoded = [p.replace(SPACE, " ").encode() if n else b"" for p, n in zip(model.pieces, model.normal)]
        for value, i in enumerate(model.byte_ids):
            self.decoded[i] = bytes([value])

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; begin, end and unknown ids add nothing."""
        ids = np.frombuffer(packed, "<u4").tolist()
        table = self.decoded
        text = b"".join([table[i] for i in ids])
        first = next((table[i] for i in ids if table[i]), b"")
        return (text[1:] if first.startswith(b" ") else text).decode("utf-8", "replace")


_BUILT: dict[tuple[type, str], Encoder | Decoder] = {}


def _built(kind: type, model: Model):
    """The worker's encoder or decoder, built once for each model."""
    key = (kind, model.digest)
    if key not in _BUILT:
        _BUILT[key] = kind(model)
    return _BUILT[key]


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", ends: bool = True) -> DataFrame:
    """``id`` and ``ids``, the packed ids (with begin and end ids if ``ends``), one row per row."""
    spark = docs.sparkSession
    python_on(spark)
    shared = spark.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        codec = _built(Encoder, model)
        before, after = (np.array([i], "<u4").tobytes() if ends else b"" for i in (model.bos, model.eos))
        for batch in batches:
            ids = [before + codec.encode(t or "") + after for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, ids binary")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (``id``, ``ids``) with ``text``, the decoded text."""
    spark = encoded.sparkSession
    python_on(spark)
    shared = spark.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _built(Decoder, shared.value)
        for batch in batches:
            texts = [codec.decode(b) for b in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "ids", "text"])

    return encoded.select("id", "ids").mapInArrow(run, "id long, ids binary, text string")


def digest(decoded: DataFrame) -> DataFrame:
    """Number and checksums of the ids, checksum of the decoded text."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
