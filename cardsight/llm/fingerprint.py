"""Document fingerprints: a Merkle tree over sections and paragraphs (operator 6).

A text's paragraphs are its lines, its sections runs of paragraphs that end
after a blank line or ``SECTION_PARAGRAPHS`` of them; a paragraph's leaves are
short runs of words, finer at its start. A leaf's digest is of its characters,
an inner node's of its children's digests, so equal roots mean equal texts and
a differing branch leads to the edit. The fingerprint writes the tree from the
root down with shortened digests::

    root:section=paragraph.leaf,leaf/paragraph.leaf;section=...

``likeness`` walks two fingerprints from the top: equal nodes settle their
whole branch, and only differing ones are opened. ``edits`` names the branches
that differ.

``fingerprints`` also compares each text with an edited form of itself, whose
last quarter is replaced by the start of the next text in id order, and with
that next text. Texts are shuffled once: ids are cut at quantiles into
buckets, each bucket is sorted and streamed by one task, and the first row of
a bucket is sent to the bucket before it as well.

Defined cases: a null text is empty, an empty text is one empty paragraph
without leaves; rows of one id (and rows without id, which come last) are
ordered by text; a table of one row has that row as its next; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsight.llm.common import python_on, stored

SECTION_PARAGRAPHS = 16
#: Words of a paragraph's first leaves; the last number goes on.
LEAF_WORDS = (1, 1, 1, 1, 2, 2, 4)
#: Text bytes a bucket should hold, and the most buckets (the cuts are on the driver).
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 100_000

_INNER = 16  # bytes of a digest inside the tree
_SHORT = 8  # hexadecimal digits of a digest below the root


def _digest(children: Iterable[bytes]) -> bytes:
    return blake2b(b"".join(children), digest_size=_INNER).digest()


def _leaves(paragraph: str) -> list[bytes]:
    words, out, at, n = paragraph.split(" "), [], 0, 0
    while at < len(words):
        size = LEAF_WORDS[min(n, len(LEAF_WORDS) - 1)]
        out.append(blake2b(" ".join(words[at : at + size]).encode(), digest_size=_INNER).digest())
        at, n = at + size, n + 1
    return out


def fingerprint(text: str) -> str:
    """The tree of a text, written out."""
    sections: list[list[tuple[bytes, list[bytes]]]] = [[]]
    for paragraph in text.split("\n"):
        leaves = _leaves(paragraph) if paragraph else []
        sections[-1].append((_digest(leaves), leaves))
        if not leaves or len(sections[-1]) >= SECTION_PARAGRAPHS:
            sections.append([])
    tops, written = [], []
    for section in filter(None, sections):
        top = _digest(d for d, _ in section)
        tops.append(top)
        paragraphs = "/".join(d.hex()[:_SHORT] + "." + ",".join([x.hex()[:_SHORT] for x in xs]) for d, xs in section)
        written.append(f"{top.hex()[:_SHORT]}={paragraphs}")
    return f"{_digest(tops).hex()}:{';'.join(written)}"


def _n_leaves(branch: str) -> int:
    """Leaves below a written branch."""
    return sum(len(p.partition(".")[2]) + 1 for p in branch.split("/") if p[-1] != ".") // (_SHORT + 1)


def _open(fp: str) -> tuple[str, list[tuple[str, str]]]:
    root, _, rest = fp.partition(":")
    return root, [tuple(s.split("=")) for s in rest.split(";") if s]


def _without(a: list, b: list) -> tuple[list, list, list]:
    """What both hold (as often as both do), and what is left of each."""
    common = Counter(a) & Counter(b)
    same: list = []
    left = []
    for items, keep in ((a, same), (b, [])):
        have, rest = Counter(common), []
        for x in items:
            if have[x]:
                have[x] -= 1
                keep.append(x)
            else:
                rest.append(x)
        left.append(rest)
    return same, left[0], left[1]


def likeness(a: str, b: str) -> float:
    """Share of leaves that two fingerprints have in common, 0 to 1."""
    (root_a, sections_a), (root_b, sections_b) = _open(a), _open(b)
    if root_a == root_b:
        return 1.0
    total = sum(_n_leaves(x) for _, x in sections_a) + sum(_n_leaves(x) for _, x in sections_b)
    same, rest_a, rest_b = _without(sections_a, sections_b)
    shared = sum(_n_leaves(x) for _, x in same)
    same, rest_a, rest_b = _without(*([p for _, x in rest for p in x.split("/")] for rest in (rest_a, rest_b)))
    shared += sum(map(_n_leaves, same))
    leaves = ([x for p in rest for x in p.partition(".")[2].split(",") if x] for rest in (rest_a, rest_b))
    shared += sum((Counter(next(leaves)) & Counter(next(leaves))).values())
    return 2.0 * shared / total if total else 0.0


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) places of ``a`` whose branch ``b`` does not have."""
    (root_a, sections_a), (root_b, sections_b) = _open(a), _open(b)
    if root_a == root_b:
        return []
    have = {s for s, _ in sections_b}
    paragraphs = {p for _, x in sections_b for p in x.split("/")}
    return [
        (i, k)
        for i, (top, x) in enumerate(sections_a)
        if top not in have
        for k, p in enumerate(x.split("/"))
        if p not in paragraphs
    ]


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the start of the following one."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _bucketed(rows: DataFrame, n_buckets: int) -> DataFrame:
    """Add ``bucket`` by cuts at quantiles of ``id``; rows without id come last."""
    probabilities = [i / n_buckets for i in range(1, n_buckets)]
    cuts = rows.approxQuantile("id", probabilities, 1.0 / (4 * n_buckets)) if probabilities else []
    inner = sorted({float(c) for c in cuts or []})
    if not inner:
        return rows.withColumn("bucket", F.col("id").isNull().cast("int"))
    splits = [float("-inf"), *inner, float("inf")]
    keyed = rows.withColumn("place", F.coalesce(F.col("id").cast("double"), F.lit(float("inf"))))
    return Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(keyed).withColumn(
        "bucket", F.when(F.col("id").isNull(), len(splits) - 1).otherwise(F.col("bucket")).cast("int")
    ).drop("place")


_OUT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, sent rows after own ones -> a result for each own row."""
    names = [c.split(" ")[0] for c in _OUT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None  # (bucket, id, text, fingerprint) of the row before
    for batch in batches:
        out: list[tuple] = []
        for bucket, sent, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None and sent:
                continue
            if held is not None and held[0] != bucket:
                raise RuntimeError("a bucket ended without the row that follows it")
            fp = fingerprint(text)
            if held is not None:
                _, key_before, before, fp_before = held
                new = edited(before, text)
                new_fp = fingerprint(new)
                out.append(
                    (key_before, len(before), sha256(new.encode()).hexdigest(), fp_before, new_fp,
                     likeness(fp_before, new_fp), likeness(fp_before, fp))
                )
            held = None if sent else (bucket, key, text, fp)
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            yield pa.RecordBatch.from_arrays(columns, names)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    spark = docs.sparkSession
    python_on(spark)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = min(MAX_BUCKETS, max(4 * partitions, -(-total // bucket_bytes)))
    placed = _bucketed(rows, n_buckets)

    # Each bucket's first id, and the bucket before it (the last, for the first): a row per bucket.
    firsts = placed.groupBy("bucket").agg(F.min("id").alias("first_id")).orderBy("bucket").collect()
    before = [(r["bucket"], r["first_id"], firsts[i - 1]["bucket"]) for i, r in enumerate(firsts)]
    halo = spark.createDataFrame(before, "of int, first_id long, to_bucket int")
    is_first = (F.col("bucket") == F.col("of")) & F.col("id").eqNullSafe(F.col("first_id"))
    sent = placed.join(F.broadcast(halo), is_first, "left")
    own = F.struct(F.col("bucket").alias("to"), F.lit(False).alias("sent"))
    copy = F.struct(F.col("to_bucket").alias("to"), F.lit(True).alias("sent"))
    targets = F.filter(F.array(own, copy), lambda t: t["to"].isNotNull())
    dealt = (
        sent.select("id", "text", F.explode(targets).alias("t"))
        .select(F.col("t.to").alias("bucket"), F.col("t.sent").alias("sent"), "id", "text")
        .repartition(max(partitions, n_buckets // 4), "bucket")
        .sortWithinPartitions("bucket", "sent", F.asc_nulls_last("id"), "text")
    )
    return dealt.mapInArrow(_compare, _OUT)
