"""Toxicity: a lexicon trie met by Levenshtein automata, with context windows (operator 7).

``fit`` learns from labelled rows, at most ``SAMPLE_ROWS`` of them:

1. a lexicon of words and stems (beginnings of words) that stand in many more
   toxic texts than others;
2. for each word and stem of it, whether words one edit away (beginnings one
   edit away) may count, which they may unless such neighbours are common in
   texts that are not toxic;
3. weights of the words that stand near hits, which separate abuse from
   quotation;
4. a logistic regression over the features of a text.

``score`` reads each text once. A word that is not in the lexicon, but shares a
form with one letter deleted with a term, is run as a Levenshtein automaton
along the trie, so a misspelled term costs the states that survive and never a
comparison with every term. Each hit has a window
of the words around it; marks of quotation and reporting verbs, and the
learned weights of the window's words, say how much of it is abuse.

Lexicon, weights and model have fixed bounds, so they travel with the task;
labels, languages, sources and ids are no inputs of a score.

Defined cases: a null or empty text has no hits and gets the score of that; a
null label is no label; several labels of one id count each; without any
label of both kinds every score is 0; repeated rows each get a row; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsight.llm.common import python_on, stored

#: Bounds of the fit.
SAMPLE_ROWS = 10_000
LEXICON_ENTRIES = 400
CONTEXT_WORDS = 1_000
#: Different units that a task holds before it passes their counts on.
HELD_UNITS = 500_000

STEM_LENGTHS = range(3, 9)
MIN_WORD = 3
#: A term stands in at least so many toxic texts and this share of them, and so
#: many times more often than in others.
MIN_SUPPORT = 5
MIN_SHARE = 0.005
MIN_LIFT = 8.0
#: Letters beyond which a word is no term and not cached.
LONGEST = 40
WINDOW = 6
CACHE_WORDS = 100_000

#: Reporting verbs and nouns that introduce a quotation.
REPORTING = frozenset(
    "said says wrote writes quote quoted quotes called calls term word slur insult report reported "
    "dit écrit cité mot sagte schrieb zitat wort dijo escribió cita palabra".split()
)
#: Opening marks of quotation and their closing ones.
QUOTES = {'"': '"', "“": "”", "„": "“", "«": "»", "‘": "’"}

_WORD = re.compile(r"\w+")
EXACT, STEM, FUZZY = "exact", "stem", "fuzzy"


# ------------------------------------------------------------------ trie and automaton


def build_trie(terms: Iterable[str]) -> dict:
    """Nested dictionaries by letter; the key ``""`` holds the term that ends there."""
    root: dict = {}
    for term in terms:
        node = root
        for letter in term:
            node = node.setdefault(letter, {})
        node[""] = term
    return root


class LevenshteinAutomaton:
    """Accepts the words at most ``edits`` insertions, deletions, substitutions or
    swaps of neighbours away from ``word`` (``beginning``: from any beginning of it). A state
    is a row of distances with the row before it."""

    def __init__(self, word: str, edits: int, beginning: bool = False):
        self.word, self.edits, self.beginning = word, edits, beginning

    def start(self) -> tuple:
        return tuple(range(len(self.word) + 1)), None, ""

    def step(self, state: tuple, letter: str) -> tuple:
        row, above, last = state
        word = self.word
        new = [row[0] + 1]
        for i, c in enumerate(word):
            d = min(row[i] + (c != letter), row[i + 1] + 1, new[i] + 1)
            if above is not None and i and c == last and word[i - 1] == letter:
                d = min(d, above[i - 1] + 1)
            new.append(d)
        return tuple(new), row, letter

    def accepts(self, state: tuple) -> bool:
        return (min(state[0]) if self.beginning else state[0][-1]) <= self.edits

    def alive(self, state: tuple) -> bool:
        return min(state[0]) <= self.edits or (state[1] is not None and min(state[1]) < self.edits)


def intersect(automaton: LevenshteinAutomaton, trie: dict) -> list[str]:
    """Terms of the trie that the automaton accepts."""
    found, todo = [], [(trie, automaton.start())]
    while todo:
        node, state = todo.pop()
        for letter, child in node.items():
            if letter == "":
                if automaton.accepts(state):
                    found.append(child)
                continue
            after = automaton.step(state, letter)
            if automaton.alive(after):
                todo.append((child, after))
    return sorted(found)


# ------------------------------------------------------------------ lexicon


class Lexicon(NamedTuple):
    """Terms with their log lifts; ``words`` match whole, ``stems`` as beginnings,
    ``fuzzy`` (words, and stems marked by ``*``) also one edit away."""

    words: dict[str, float]
    stems: dict[str, float]
    fuzzy: frozenset[str]


def _deleted(term: str) -> set[str]:
    """The term without each of its letters."""
    return {term[:i] + term[i + 1 :] for i in range(len(term))}


class Matcher:
    """Finds the lexicon's entry for a word; a worker's cache within a bound."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        fuzzy_words = {t for t in lexicon.fuzzy if not t.endswith("*")}
        fuzzy_stems = {t[:-1] for t in lexicon.fuzzy if t.endswith("*")}
        self.trie, self.stem_trie = build_trie(fuzzy_words), build_trie(fuzzy_stems)
        self.stem_lengths = sorted({len(s) for s in lexicon.stems})
        # Terms one edit away from a word share a form with it, each with one letter deleted or none.
        self.sizes = {len(t) + d for t in fuzzy_words for d in (-1, 0, 1)}
        self.forms = fuzzy_words.union(*map(_deleted, fuzzy_words))
        self.stems = {n: {t for t in fuzzy_stems if len(t) == n} for n in {len(t) for t in fuzzy_stems}}
        self.stem_forms = {n: terms.union(*map(_deleted, terms)) for n, terms in self.stems.items()}
        self.cache: dict[str, tuple[str, str] | None] = {}

    def __call__(self, word: str) -> tuple[str, str] | None:
        """(entry, how it matched), or None."""
        if word in self.cache:
            return self.cache[word]
        hit = self._find(word)
        if len(word) <= LONGEST:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = hit
        return hit

    def _find(self, word: str) -> tuple[str, str] | None:
        if word in self.lexicon.words:
            return word, EXACT
        for n in self.stem_lengths:
            if len(word) >= n and word[:n] in self.lexicon.stems:
                return word[:n], STEM
        near = self.near(word)
        return (near[0].rstrip("*"), FUZZY) if near else None

    def near(self, word: str) -> list[str]:
        """Fuzzy terms one edit away from a word, then those (marked) of a beginning of it."""
        found: list[str] = []
        if len(word) in self.sizes and (word in self.forms or not self.forms.isdisjoint(_deleted(word))):
            found = intersect(LevenshteinAutomaton(word, 1), self.trie)
        if any(
            word[: n - 1] in forms or word[:n] in forms
            or not forms.isdisjoint(_deleted(word[:n])) or not self.stems[n].isdisjoint(_deleted(word[: n + 1]))
            for n, forms in self.stem_forms.items()
        ):
            beginning = LevenshteinAutomaton(word[: max(self.stems) + 1], 1, beginning=True)
            found += [t + "*" for t in intersect(beginning, self.stem_trie)]
        return found


class Hit(NamedTuple):
    entry: str
    how: str
    quoted: bool
    window: list[str]


def _quoted_stretches(text: str) -> list[tuple[int, int]]:
    """Stretches between marks of quotation; an open mark without its end is none."""
    out, at = [], 0
    for m in re.finditer("[" + "".join(QUOTES) + "]", text):
        if m.start() >= at:
            end = text.find(QUOTES[m.group()], m.end())
            line = text.find("\n", m.end())
            if end >= 0 and (line < 0 or end < line):
                out.append((m.end(), end))
                at = end + 1
    return out


def hits_of(text: str, match: Matcher) -> tuple[list[Hit], int]:
    """The hits of a text with their windows, and its number of words."""
    lower = text.lower()
    words = _WORD.findall(lower)
    known = {w: h for w in set(words) if len(w) >= MIN_WORD and (h := match(w))}
    if not known:
        return [], len(words)
    stretches = _quoted_stretches(lower) if any(q in lower for q in QUOTES) else []
    out = []
    for i, m in enumerate(_WORD.finditer(lower)):
        if m.group() in known:
            window = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
            quoted = any(a <= m.start() < b for a, b in stretches) or any(w in REPORTING for w in window)
            out.append(Hit(*known[m.group()], quoted, window))
    return out, len(words)


# ------------------------------------------------------------------ features and model


class Model(NamedTuple):
    lexicon: Lexicon
    context: dict[str, float]
    mean: list[float]
    scale: list[float]
    coefficients: list[float]
    intercept: float


def features(text: str, match: Matcher, context: dict[str, float]) -> list[float]:
    """What the regression sees of a text; abuse and quotation apart."""
    hits, n_words = hits_of(text, match)
    lexicon = match.lexicon
    abuse = quoted = near = 0.0
    best = 0.0
    terms = set()
    for h in hits:
        lift = lexicon.words.get(h.entry) or lexicon.stems.get(h.entry, 0.0)
        # The window's vote: below zero it speaks for quotation or for chance.
        vote = sum(context.get(w, 0.0) for w in h.window) / (len(h.window) or 1)
        if h.how == FUZZY:
            near += 1
        if h.quoted:
            quoted += 1
        else:
            abuse += 1
            terms.add(h.entry)
            best = max(best, lift + vote)
    return [
        math.log1p(abuse),
        math.log1p(quoted),
        math.log1p(near),
        math.log1p(len(terms)),
        best,
        math.log((abuse + 0.5) / (n_words + 10.0)),
        1.0 if abuse else 0.0,
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's method on standardized features."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    penalty = np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + penalty * w
        hessian = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _count_in_tasks(sample: DataFrame, units_of: Callable[[], Callable[[str], Iterable[str]]]) -> DataFrame:
    """``unit, toxic, clean``: texts of either label that hold each unit, summed
    per task, then in all. ``units_of`` is called once in each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of()
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def emit() -> pa.RecordBatch:
            names = list(counts[0] | counts[1])
            columns = [pa.array([counts[k][u] for u in names], pa.int64()) for k in (1, 0)]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *columns], ["unit", "toxic", "clean"])

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(set(units(text)))
            if len(counts[0]) + len(counts[1]) > HELD_UNITS:
                yield emit()
        yield emit()

    return (
        sample.select("text", "toxic").mapInArrow(run, "unit string, toxic long, clean long")
        .groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


def _terms(text: str) -> set[str]:
    """Words, and stems marked by ``*``."""
    words = {w for w in set(_WORD.findall(text.lower())) if len(w) >= MIN_WORD and not w[0].isdigit()}
    return {w for w in words if len(w) <= LONGEST} | {w[:n] + "*" for w in words for n in STEM_LENGTHS if len(w) > n}


def _lift(n_toxic: int, n_clean: int) -> Column:
    return ((F.col("toxic") + 0.5) / (n_toxic + 1.0)) / ((F.col("clean") + 0.5) / (n_clean + 1.0))


def choose_lexicon(rows: list[tuple[str, int, float]]) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems from candidates (unit, toxic texts, lift): the shortest stem
    that holds for a family of words stands for it; a word without family stands alone."""
    stems: dict[str, float] = {}
    words: dict[str, float] = {}
    by_unit = {u: (n, lift) for u, n, lift in rows}
    for unit, n, lift in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        stem = unit[:-1] if unit.endswith("*") else None
        if any((stem or unit)[:k] in stems for k in STEM_LENGTHS if k <= len(stem or unit)):
            continue
        if stem is None:
            words[unit] = math.log(lift)
        else:
            # A stem of a single long word says no more than the word.
            alone = any(u.startswith(stem) and not u.endswith("*") and m >= 0.8 * n for u, (m, _) in by_unit.items())
            if not alone:
                stems[stem] = math.log(lift)
    words = {w: v for w, v in words.items() if not any(w[:k] in stems for k in STEM_LENGTHS)}
    return words, stems


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Learn from ``labels`` (``id_col``, ``toxic``): the ``sample_rows`` first
    by a seeded order of ids. None if they do not show both labels."""
    python_on(docs.sparkSession)
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.md5(F.col("id").cast("string")), "id", "toxic").limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n_tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = stored(texts.join(chosen, "id").select("text", "toxic").repartition(n_tasks), "toxicity-sample")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return None

    support = max(MIN_SUPPORT, int(MIN_SHARE * n[1]))
    lift = _lift(n[1], n[0])
    # Only what stands in enough toxic texts is counted in the others.
    frequent = _count_in_tasks(sample.where("toxic = 1"), lambda: _terms).where(F.col("toxic") >= support)
    candidates = {r["unit"]: r["toxic"] for r in frequent.collect()}  # in ``support`` texts of the sample or more
    clean = _count_in_tasks(sample.where("toxic = 0"), lambda: lambda text: candidates.keys() & _terms(text))
    clean_texts = {r["unit"]: r["clean"] for r in clean.collect()}  # at most one row per candidate
    rows = []
    for unit, toxic in candidates.items():
        ratio = ((toxic + 0.5) / (n[1] + 1.0)) / ((clean_texts.get(unit, 0) + 0.5) / (n[0] + 1.0))
        if ratio >= MIN_LIFT:
            rows.append((unit, toxic, ratio))
    rows = sorted(rows, key=lambda r: (-r[2], r[0]))[: 4 * LEXICON_ENTRIES]
    words, stems = choose_lexicon(rows)
    words = dict(sorted(words.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_ENTRIES])

    # Which terms have neighbours that are ordinary words?
    terms = frozenset(words) | {s + "*" for s in stems}
    trial = Lexicon(words, stems, terms)

    def neighbours() -> Callable[[str], Iterable[str]]:
        match = _matcher(trial)

        def units(text: str) -> Iterator[str]:
            for w in set(_WORD.findall(text.lower())):
                if len(w) >= MIN_WORD and (h := match(w)) and h[1] == FUZZY:
                    yield from match.near(w)

        return units

    common = _count_in_tasks(sample, neighbours).where(_lift(n[1], n[0]) < MIN_LIFT).where("clean > 0")
    ordinary = {r["unit"] for r in common.collect()}  # at most one row per lexicon term
    lexicon = Lexicon(words, stems, terms - ordinary)

    def windows() -> Callable[[str], Iterable[str]]:
        match = _matcher(lexicon)
        return lambda text: (w for h in hits_of(text, match)[0] for w in h.window)

    context = {
        r["unit"]: math.log(r["lift"])
        for r in _count_in_tasks(sample, windows).where("toxic + clean >= 5").withColumn("lift", lift)
        .orderBy(F.desc(F.col("toxic") + F.col("clean")), "unit").limit(CONTEXT_WORDS).collect()
    }
    # Lifts are of the base rate among texts with hits: centre them, so an ordinary window votes zero.
    middle = float(np.median(list(context.values()))) if context else 0.0
    context = {w: max(-2.0, min(2.0, v - middle)) for w, v in context.items()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = _matcher(lexicon)
        for batch in batches:
            x = [features(t, match, context) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    seen = sample.select("text", "toxic").mapInArrow(run, "x array<double>, toxic int").orderBy("toxic", "x").collect()
    x, y = np.array([r["x"] for r in seen]), np.array([r["toxic"] for r in seen], dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    w, b = fit_logistic((x - mean) / scale, y)
    return Model(lexicon, context, mean.tolist(), scale.tolist(), w.tolist(), b)


_MATCHERS: dict[Lexicon, Matcher] = {}


def _matcher(lexicon: Lexicon) -> Matcher:
    key = (tuple(lexicon.words), tuple(lexicon.stems), lexicon.fuzzy)
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(lexicon)
    return _MATCHERS[key]


def score_text(text: str, model: Model | None, match: Matcher | None) -> float:
    if model is None or match is None:
        return 0.0
    x = features(text, match, model.context)
    z = model.intercept + sum(w * (v - m) / s for w, v, m, s in zip(model.coefficients, x, model.mean, model.scale))
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def score_column(spark, model: Model | None) -> Callable[[Column], Column]:
    """A column function from text to score; null texts are empty."""
    python_on(spark)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        match = _matcher(model.lexicon) if model else None
        for column in texts:
            yield pa.array([score_text(t or "", model, match) for t in column.to_pylist()], pa.float64())
        if match:  # the worker goes on to other stages
            match.cache.clear()

    scored = F.arrow_udf(run, "double")
    return lambda text: scored(text.cast("string"))


def held_out(id_column: Column) -> Column:
    """Whether a row's label is kept for the test: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, score, predicted``, one row per row of ``docs``; learned
    from the labels of rows that are not held out."""
    model = fit(docs, labels.where(~held_out(F.col(id_col))), id_col, text_col)
    scored = docs.select(
        F.col(id_col).cast("long").alias("id"),
        held_out(F.col(id_col)).alias("held_out"),
        score_column(docs.sparkSession, model)(F.col(text_col)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score reaches ``threshold``."""
    model = fit(docs, labels, id_col, text_col)
    return docs.where(score_column(docs.sparkSession, model)(F.col(f"`{text_col}`")) < threshold)
