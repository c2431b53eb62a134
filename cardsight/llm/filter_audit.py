r"""Filter interaction audit by decision diagrams (operator 12).

Each document gets a mask of the filters that it fails. Masks are counted per
part (language), so a part is at most ``2 ** n_filters`` weighted masks
however many documents it has. Its decision diagram has one level per filter:
a node's low edge holds the documents that pass the level's filter, its high
edge those that fail it, equal parts of the diagram are one node, and the
leaves carry counts. Applying filters in the order of the levels walks the
all-pass path: at each level the high edge holds what the step removes, the
low edge what it keeps. All orders of the filters are visited by swapping two
neighbouring levels at a time (plain changes), which rebuilds the nodes of
these two levels only.

Filters of the registered query, on whole texts (words: maximal runs without
ASCII white space): A under ``MIN_WORDS`` words; B too few distinct words; C
too many capitals A-Z; D a character of ``MARKS``; E the text of any document
of smaller id, removed or not.

Texts are read once, in bounded pieces, and are not shuffled: rows of id,
part, mask and SHA-256 of the text are. Copies of one text are spread by their
ids; a text's smallest id is found with map-side aggregation.

Defined cases: null texts are empty (and equal to empty texts); null parts are
the part of the empty string; a row without an id has no smaller and no larger
id, so it neither fails E nor makes another fail, and has no label; repeated
rows of an id and text are separate rows, none smaller than the other; a label
holds if any label row of the id has it, null labels do not; only parts that
have rows are returned, so an empty table gives an empty result; ties cannot
occur, and other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsight.llm.common import python_on, stored

FILTERS = "ABCDE"
#: The thresholds of the filters.
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
MARKS = b"#$%&*|"
#: Bytes of a text that are cut into words at a time.
PIECE_BYTES = 1 << 20

_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUATION = bytes(range(0x80, 0xC0))  # bytes that begin no code point
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about ``PIECE_BYTES``, cut where there is ASCII white space."""
    at = 0
    while len(text) - at > PIECE_BYTES and (space := _SPACE.search(text, at + PIECE_BYTES)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:]


def text_mask(text: bytes) -> int:
    """The filters A to D that a text fails, filter ``i`` as bit ``i``."""
    n, distinct = 0, set()
    for piece in pieces(text):
        words = piece.split()  # bytes split at ASCII white space only
        n += len(words)
        distinct.update(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    code_points = len(text.translate(None, _CONTINUATION))
    marks = len(text) - len(text.translate(None, MARKS))
    return (
        (n < MIN_WORDS)
        | (100 * len(distinct) < MIN_DISTINCT_PERCENT * n) << 1
        | (100 * capitals > MAX_CAPITALS_PERCENT * code_points) << 2
        | (marks > 0) << 3
    )


def _masks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                pa.array([text_mask(t) for t in texts], pa.int32()),
            ],
            ["id", "part", "text", "mask"],
        )


def failure_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """``part, mask, n, good, toxic``: documents per part and set of failed filters."""
    python_on(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("string").alias("text"),
    ).mapInArrow(_masks, "id long, part string, text binary, mask int")
    # Rows of one id, part and text are one row with a count from here on.
    counted = stored(rows.groupBy("id", "part", "text", "mask").agg(F.count("*").alias("n")), "audit-masks")
    smallest = counted.where("id IS NOT NULL").groupBy("text").agg(F.min("id").alias("id"))
    named = counted.where("id IS NOT NULL")
    # Joined on text and id, so that the copies of one text are not one key.
    is_first = named.join(smallest.withColumn("first", F.lit(True)), ["text", "id"], "left")
    copy = F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    holds = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c)
    of_id = (
        labels.select(F.col(id_col).cast("long").alias("id"), "quality", "toxic").where("id IS NOT NULL")
        .groupBy("id").agg(holds("quality"), holds("toxic"))
    )
    masked = (
        is_first.select("id", "part", (F.col("mask") + copy).alias("mask"), "n").join(of_id, "id", "left")
        .select("part", "mask", "n", F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
        .union(counted.where("id IS NULL").select("part", "mask", "n", F.lit(0), F.lit(0)))
    )
    return masked.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


# ------------------------------------------------------------------ diagrams


class Diagram:
    """A decision diagram over masks with counts at its leaves.

    ``order[d]`` is the variable of level ``d``; ``levels[d]`` maps a node's
    number to its low and high child on the next level; the children of the last
    level are keys of ``leaves``, tuples of counts.
    """

    def __init__(self, counts: dict[int, tuple[int, ...]], n_variables: int, n_counts: int):
        self.order = list(range(n_variables))
        self.levels: list[dict[int, tuple]] = [{} for _ in range(n_variables)]
        self._known: list[dict[tuple, int]] = [{} for _ in range(n_variables)]
        self._next = 0
        self._weight: dict[int, tuple[int, ...]] = {}
        zero = (0,) * n_counts

        def build(depth: int, mask: int):
            if depth == n_variables:
                return counts.get(mask, zero)
            return self._node(depth, build(depth + 1, mask), build(depth + 1, mask | 1 << depth))

        self.root = build(0, 0)

    def _node(self, depth: int, low, high) -> int:
        """The node of these children: equal nodes of a level are one."""
        known = self._known[depth]
        if (low, high) not in known:
            known[low, high] = self._next
            self.levels[depth][self._next] = (low, high)
            self._weight[self._next] = tuple(a + b for a, b in zip(self.weight(low), self.weight(high)))
            self._next += 1
        return known[low, high]

    def weight(self, node) -> tuple[int, ...]:
        """Summed counts below a node (a leaf is its own counts)."""
        return node if isinstance(node, tuple) else self._weight[node]

    def swap(self, depth: int) -> None:
        """Exchange levels ``depth`` and ``depth + 1``. Nodes of the upper level keep their
        numbers, as what they stand for is the same, so nothing above changes."""
        old, below = self.levels[depth + 1], depth + 1
        for node in old:
            del self._weight[node]
        self.levels[below], self._known[below] = {}, {}
        for node, (low, high) in self.levels[depth].items():
            (pp, pf), (fp, ff) = old[low], old[high]
            self.levels[depth][node] = (self._node(below, pp, fp), self._node(below, pf, ff))
        self._known[depth] = {children: node for node, children in self.levels[depth].items()}
        self.order[depth], self.order[below] = self.order[below], self.order[depth]

    def all_pass(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """Along the all-pass path: the level's variable, the counts kept and those removed."""
        node = self.root
        for variable, level in zip(self.order, self.levels):
            low, high = level[node]
            yield variable, self.weight(low), self.weight(high)
            node = low


def plain_changes(n: int) -> Iterator[int]:
    """Places ``i`` whose exchange with ``i + 1``, one after the other, visits all orders of ``n``."""
    if n < 2:
        return
    down = True
    for inner in [*plain_changes(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if inner is not None:  # the moving element stands at the first or the last place
            yield inner + 1 if down else inner
        down = not down


def part_steps(counts: dict[int, tuple[int, int, int]], filters: str = FILTERS) -> list[tuple]:
    """Steps of all orders of one part: ``filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley``."""
    n = len(filters)
    fails = [sum(c[0] for m, c in counts.items() if m >> v & 1) for v in range(n)]
    only = [counts.get(1 << v, (0, 0, 0))[0] for v in range(n)]
    diagram, rows, shapley = Diagram(counts, n, 3), [], [0] * n

    def visit() -> None:
        name = "".join(filters[v] for v in diagram.order)
        for step, (v, kept, gone) in enumerate(diagram.all_pass(), 1):
            shapley[v] += gone[0]
            rows.append((name, step, v, kept[0], gone[0], fails[v] - gone[0], only[v], gone[1], gone[2]))

    visit()
    for place in plain_changes(n):
        diagram.swap(place)
        visit()
    return [(name, step, *numbers, shapley[v]) for name, step, v, *numbers in rows]


_STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def _audit(group: pd.DataFrame) -> pd.DataFrame:
    counts = {m: c for m, *c in group[["mask", "n", "good", "toxic"]].itertuples(index=False, name=None)}
    steps = part_steps({m: tuple(c) for m, c in counts.items()})
    return pd.DataFrame([(group["part"].iloc[0], *s) for s in steps], columns=[c.split(" ")[0] for c in _STEPS.split(", ")])


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """One row per part, order of the filters and step."""
    counts = failure_counts(docs, labels, id_col, text_col, part_col)
    return counts.groupBy("part").applyInPandas(_audit, _STEPS)  # at most 32 rows a part


_ORDERS = ", ".join(f"('{''.join(p)}')" for p in permutations(FILTERS))

#: The same steps in DuckDB SQL.
ORACLE_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), judged AS (
  SELECT part, doc_id,
    (len(words) < {MIN_WORDS})::INT + 2 * (100 * len(list_distinct(words)) < {MIN_DISTINCT_PERCENT} * len(words))::INT
    + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MAX_CAPITALS_PERCENT} * length(text))::INT
    + 8 * regexp_matches(text, '[{MARKS.decode()}]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask
  FROM docs
), held AS (
  SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM judged LEFT JOIN held USING (doc_id) GROUP BY part, mask
), steps AS (
  SELECT filter_order, step, ascii(filter_order[step]) - 65 AS v,
    list_reduce(list_prepend(0, [1 << (ascii(c) - 65) for c in string_split(filter_order[:step - 1], '') if c <> '']), lambda a, b: a + b) AS earlier
  FROM (VALUES {_ORDERS}) AS o(filter_order), range(1, 6) AS s(step)
), told AS (
  SELECT part, filter_order, step, v,
    sum(n) FILTER (mask & earlier = 0 AND (mask >> v) & 1 = 0) AS kept,
    sum(n) FILTER (mask & earlier = 0 AND (mask >> v) & 1 = 1) AS removed,
    sum(n) FILTER (mask & earlier <> 0 AND (mask >> v) & 1 = 1) AS redundant,
    sum(n) FILTER (mask = 1 << v) AS unique_fails,
    sum(good) FILTER (mask & earlier = 0 AND (mask >> v) & 1 = 1) AS good_lost,
    sum(toxic) FILTER (mask & earlier = 0 AND (mask >> v) & 1 = 1) AS toxic_lost
  FROM counts, steps GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, v))::BIGINT AS shapley
FROM told
"""
