"""Toxicity (operator 10): a lexicon learned from labels, found in any spelling by Levenshtein automata, weighed in context.

1. `learn` takes a bounded sample of labelled documents (SAMPLE, the smallest hashes of doc_id; Spark joins them to the texts).
   Words and stems that toxic documents hold far more often are counted in Spark; of the strongest (CANDIDATES) a greedy cover of
   the toxic documents is kept as the lexicon, so that the chance words of a copied document don't enter.
2. The lexicon is a trie. Intersected with a Levenshtein automaton for each term (one edit from five letters, two from nine; stems
   from six) it becomes one deterministic automaton, run over all words of a batch at once. Forms that the sample knows as clean
   words are exceptions.
3. Each hit is scored in a window of words around it: quotation marks and reporting words speak for a quotation, address and
   further hits for abuse. A logistic regression over the document's sums of both gives the score.

Labels, languages and sources are no inputs of a score. Null and empty texts score as a document without a hit does. Rows may
repeat; each gets its score. Without labels of both kinds nothing can be learned, and every score is 0.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.text import chunks, fresh, hash_spans, spans, utf8

SAMPLE = 20_000
CANDIDATES = 2_000
TERMS = 200
STEMS = range(4, 8)
WINDOW = 12
#: Words and marks that speak for a quotation, and forms of address.
REPORTING = ["said", "says", "wrote", "quote", "quoted", "quotes", "called", "word", "term", "phrase", "reported", "cited"]
ADDRESS = ["you", "your", "youre", "u", "yourself"]
QUOTES = "\"“”«»„‟"
FEATURES = 7


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, code points) of a column, A-Z and the Latin-1 capitals in lower case."""
    offsets, data = utf8(column)
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    capital = ((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE) & (points != 0xD7))
    return first[offsets], np.where(capital, points + 32, points)


def letters(points: np.ndarray) -> np.ndarray:
    """Part of a word: letters, digits, and everything above ASCII but marks and spaces."""
    ascii_word = ((points >= 97) & (points <= 122)) | ((points >= 48) & (points <= 57))
    return ascii_word | ((points >= 0xC0) & (points != 0xD7) & (points != 0xF7) & ~((points >= 0x2000) & (points <= 0x206F)) & (points != 0x3000))


def edits_of(term: str, stem: bool) -> int:
    return int(len(term) >= 6) if stem else (len(term) >= 5) + (len(term) >= 9)


@dataclass
class Automaton:
    """The lexicon's trie and the Levenshtein automata of its terms as one deterministic automaton.

    `move[state, letter]`, state 0 dead; `closed[state]`: the term that ends there, or -1; `opened`: the stem that is complete;
    `edits[state]`: the edits spent. Letters are places in `alphabet`, 0 for all others.
    """

    alphabet: np.ndarray
    move: np.ndarray
    closed: np.ndarray
    opened: np.ndarray
    edits: np.ndarray

    def run(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(indices of the words that match, their terms, edits)."""
        place = np.searchsorted(self.alphabet, points)
        place[place == len(self.alphabet)] = 0
        letter = np.where(len(self.alphabet) and self.alphabet[place] == points, place + 1, 0)
        live, state, at = np.arange(len(starts)), np.ones(len(starts), np.int32), starts.copy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(live):
            state = self.move[state, letter[at]]
            at = at + 1
            whole, over = self.opened[state] >= 0, at == ends[live]  # a stem with edits may yet turn out to be exact
            found.append((live[whole], self.opened[state[whole]], self.edits[state[whole]]))
            done = over & ~whole & (self.closed[state] >= 0)
            found.append((live[done], self.closed[state[done]], self.edits[state[done]]))
            on = (state > 0) & ~over & ~(whole & (self.edits[state] == 0))
            live, state, at = live[on], state[on], at[on]
        hit, term, edits = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found, strict=True) if found else ([], [], [])))
        order = np.lexsort((edits, hit))
        best = order[np.diff(hit[order], prepend=-1) != 0]
        return hit[best], term[best], edits[best]


def automaton(terms: list[tuple[str, bool]]) -> Automaton:
    """terms: (text, whether it is a stem, which any ending may follow)."""
    alphabet = sorted({ord(c) for t, _ in terms for c in t})
    children: list[dict[int, int]] = [{}]
    end: dict[int, tuple[int, bool]] = {}
    allowed = [0]  # the most edits that a term below the node takes
    for k, (term, stem) in enumerate(terms):
        node, most = 0, edits_of(term, stem)
        allowed[0] = max(allowed[0], most)
        for c in term:
            if ord(c) not in children[node]:
                children[node][ord(c)] = len(children)
                children.append({})
                allowed.append(0)
            node = children[node][ord(c)]
            allowed[node] = max(allowed[node], most)
        end.setdefault(node, (k, stem))

    def closure(items: dict[int, int]) -> frozenset[tuple[int, int]]:
        """node: fewest edits spent; letters of the term may be left out."""
        todo = list(items.items())
        while todo:
            node, spent = todo.pop()
            if items[node] < spent:
                continue
            for child in children[node].values():
                if spent + 1 <= allowed[child] and spent + 1 < items.get(child, 99):
                    items[child] = spent + 1
                    todo.append((child, spent + 1))
        return frozenset((n, s) for n, s in items.items() if s <= allowed[n])

    start = closure({0: 0})
    ids, queue, move, closed, opened, edits = {frozenset(): 0, start: 1}, [frozenset(), start], [], [], [], []
    at = 0
    while at < len(queue):
        here = queue[at]
        at += 1
        ends = [(spent, *end[n]) for n, spent in here if n in end and spent <= edits_of(*terms[end[n][0]])]
        whole = min((x for x in ends if not x[2]), default=(0, -1))
        stem = min((x for x in ends if x[2]), default=(0, -1))
        closed.append(whole[1])
        opened.append(stem[1])
        edits.append(stem[0] if stem[1] >= 0 else whole[0])
        row = []
        for letter in [0, *alphabet] if here and (stem[1] < 0 or stem[0] > 0) else []:
            after: dict[int, int] = {}
            for node, spent in here:
                steps = [(child, spent + (c != letter)) for c, child in children[node].items()] + [(node, spent + 1)]
                for child, cost in steps:
                    if cost <= allowed[child] and cost < after.get(child, 99):
                        after[child] = cost
            key = closure(after)
            if key not in ids:
                ids[key] = len(queue)
                queue.append(key)
            row.append(ids[key])
        move.append(row or [0] * (len(alphabet) + 1))
    return Automaton(np.array(alphabet, np.uint32), np.array(move, np.int32), *(np.array(x, np.int32) for x in (closed, opened, edits)))


@dataclass
class Model:
    terms: list[tuple[str, bool]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of the terms
    exceptions: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # hashes of forms
    beta: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    machine: Automaton | None = None


def word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return hash_spans(points, starts, ends)


def hits(model: Model, offsets: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hit words, terms, edits, starts, ends, first word of each row); exceptions are left out."""
    starts, ends, first = spans(letters(points), offsets)
    word, term, edits = model.machine.run(points, starts, ends)
    if len(model.exceptions) and len(word):
        ok = (edits == 0) | ~np.isin(word_hashes(points, starts[word], ends[word]), model.exceptions)
        word, term, edits = word[ok], term[ok], edits[ok]
    return word, term, edits, starts, ends, first


def features(model: Model, column: pa.Array) -> np.ndarray:
    """A row of features per document: a constant, abuse in exact and in other spelling, quotation, density, variety, crowding."""
    offsets, points = code_points(column)
    n = len(offsets) - 1
    out = np.zeros((n, FEATURES))
    out[:, 0] = 1
    if model.machine is None or not len(points):
        return out
    word, term, edits, starts, ends, first = hits(model, offsets, points)
    if not len(word):
        return out
    row = np.searchsorted(first, word, side="right") - 1
    low, high = np.maximum(word - WINDOW, first[row]), np.minimum(word + WINDOW + 1, first[row + 1])
    quote = np.concatenate([[0], np.cumsum(np.isin(points, QUOTE_POINTS))])
    left = quote[starts[word]] - quote[np.where(low > 0, ends[np.maximum(low - 1, 0)], 0).clip(offsets[row], starts[word])]
    right = quote[starts[high - 1]] - quote[ends[word].clip(None, starts[high - 1])] + (quote[np.minimum(ends[high - 1] + 1, offsets[row + 1])] - quote[starts[high - 1]])
    enclosed = (left % 2 == 1) & (right > 0)
    # The words of the windows are hashed only around hits.
    near = np.unique(np.concatenate([np.minimum(word + d, len(starts) - 1).clip(0) for d in range(-WINDOW, WINDOW + 1)]))
    kind = word_hashes(points, starts[near], ends[near])
    told, address = (np.concatenate([[0], np.cumsum(np.isin(kind, x))]) for x in (REPORTING_HASHES, ADDRESS_HASHES))
    a, b = np.searchsorted(near, low), np.searchsorted(near, high)
    crowd = np.searchsorted(word, high) - np.searchsorted(word, low)
    # The context window's score: above 0 for abuse, below for a quotation.
    context = 1.0 + 0.5 * (address[b] - address[a]).clip(0, 2) + 0.25 * (crowd - 1).clip(0, 4) - 1.5 * enclosed - 0.75 * (told[b] - told[a]).clip(0, 2)
    weight = model.weights[term] * np.where(edits == 0, 1.0, 0.7)
    abuse = weight * context.clip(0, None)
    total = lambda x: np.bincount(row, x, n)
    words = np.maximum(np.diff(first), 1)
    out[:, 1] = np.log1p(total(abuse * (edits == 0)))
    out[:, 2] = np.log1p(total(abuse * (edits > 0)))
    out[:, 3] = np.log1p(total(weight * (context <= 0)))
    out[:, 4] = np.sqrt(total(abuse) / words)
    pairs = np.unique(np.stack([row, term]), axis=1)[0]
    out[:, 5] = np.log1p(np.bincount(pairs, minlength=n))
    np.maximum.at(out[:, 6], row, np.log1p(crowd - 1.0))
    return out


QUOTE_POINTS = np.array([ord(c) for c in QUOTES], np.uint32)


def _hashes(words: list[str]) -> np.ndarray:
    offsets, points = code_points(pa.array(words))
    return word_hashes(points, offsets[:-1], offsets[1:])


REPORTING_HASHES, ADDRESS_HASHES = _hashes(REPORTING), _hashes(ADDRESS)


def document_words(texts: pa.Array) -> Iterator[set[str]]:
    offsets, points = code_points(texts)
    starts, ends, first = spans(letters(points), offsets)
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    own = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    for a, b in zip(first, first[1:], strict=False):
        yield set(own[a:b])


def terms_of(words: set[str]) -> set[str]:
    """Words, ended by a blank, and stems."""
    return {w + " " for w in words if len(w) > 2} | {w[:n] for w in words for n in STEMS if len(w) > n}


def sampled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of at most `sample` labelled documents, the smallest hashes of doc_id first; a null label is none."""
    chosen = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic").where("text is not null")


def counted(rows: DataFrame) -> DataFrame:
    """(term, toxic documents, other documents); partial sums leave each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())
        out = lambda: pa.record_batch([pa.array(k := list(held[0].keys() | held[1].keys()), pa.string()), *[pa.array([h[x] for x in k], pa.int64()) for h in (held[1], held[0])]], names=["term", "bad", "good"])
        for batch in chunks(batches):
            for words, label in zip(document_words(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                held[label > 0].update(terms_of(words))
            if len(held[0]) + len(held[1]) > 200_000:
                yield out()
                held = (Counter(), Counter())
        yield out()

    return rows.mapInArrow(run, "term string, bad long, good long").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def fitted(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton's method."""
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty * len(y) / 100 * np.eye(x.shape[1]) + 1e-6 * np.eye(x.shape[1]), x.T @ (y - p) - penalty * len(y) / 100 * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def covering(cover: dict[int, set[int]], names: list[str], least: int, most: int) -> list[int]:
    """Terms by the toxic documents they add, while they add `least`; then those nearly as common as the first. No term is
    taken that a chosen stem starts."""
    left, chosen = set().union(*cover.values()), []
    new = lambda t: not any(names[t].startswith(names[c]) for c in chosen)
    gain = lambda t: len(cover[t] & left) * (1.0 if names[t].endswith(" ") else 0.9)  # noqa: E731  a whole word before its stem
    while len(chosen) < most:
        t = max((t for t in cover if t not in chosen and new(t)), key=lambda t: (gain(t), len(names[t]), -t), default=None)
        if t is None or len(cover[t] & left) < least:
            break
        chosen.append(t)
        left -= cover[t]
    enough = 0.3 * max((len(cover[t]) for t in chosen), default=0)
    for t in sorted(cover, key=lambda t: (-len(cover[t]), t)):
        if len(chosen) < most and len(cover[t]) >= enough and t not in chosen and new(t):
            chosen.append(t)
    return chosen


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS) -> Model:
    """Fits lexicon, exceptions and weights on at most `sample` labelled documents. What reaches the driver is bounded by it."""
    rows = sampled(docs, labels, sample)
    kinds = {r.bad: r["count"] for r in rows.groupBy((F.col("toxic") > 0).alias("bad")).count().collect()}
    bad, good = kinds.get(True, 0), kinds.get(False, 0)
    model = Model()
    if not bad or not good:
        model.beta[0] = -30.0
        return model
    least = max(3, bad // 200)
    odds = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1))
    strong = counted(rows).where(F.col("bad") >= least).withColumn("odds", odds).where("odds >= 8").orderBy((F.log("odds") * F.sqrt("bad")).desc(), "term").limit(CANDIDATES)
    found = [(r.term, math.log(r.odds)) for r in strong.collect()]
    index = {t: i for i, (t, _) in enumerate(found)}

    def holds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            own = [[index[t] for t in terms_of(w) if t in index] for w in document_words(batch.column("text"))]
            yield pa.record_batch([batch.column("toxic"), pa.array(own, pa.list_(pa.int32()))], names=["toxic", "terms"])

    cover: dict[int, set[int]] = defaultdict(set)
    for k, r in enumerate(rows.mapInArrow(holds, "toxic int, terms array<int>").where("toxic > 0 and size(terms) > 0").collect()):
        for t in r.terms:
            cover[t].add(k)
    chosen = covering(cover, [t for t, _ in found], least, terms)
    model.terms = [(found[t][0].rstrip(" "), not found[t][0].endswith(" ")) for t in chosen]
    model.weights = np.array([found[t][1] for t in chosen])
    model.machine = automaton(model.terms)
    forms = forms_found(rows, model).groupBy("form").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where((F.col("bad") + 0.5) / (bad + 1) < 4 * (F.col("good") + 0.5) / (good + 1)).where("good > 0")
    model.exceptions = np.sort(np.array([r.form for r in forms.select("form").collect()], np.int64).view(np.uint64))
    data = np.array([[r.toxic > 0, *r.x] for r in with_features(rows, model).collect()])
    model.beta = fitted(data[:, 1:], data[:, 0])
    return model


def forms_found(rows: DataFrame, model: Model) -> DataFrame:
    """(form, documents of either kind) of the forms that match with edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            offsets, points = code_points(batch.column("text"))
            word, _, edits, starts, ends, first = hits(model, offsets, points)
            word = word[edits > 0]
            row = np.searchsorted(first, word, side="right") - 1
            form = word_hashes(points, starts[word], ends[word]) if len(word) else np.zeros(0, np.uint64)
            bad = batch.column("toxic").to_numpy(zero_copy_only=False)[row] > 0
            yield pa.record_batch([pa.array(form.view(np.int64)), pa.array(bad.astype(np.int64)), pa.array((~bad).astype(np.int64))], names=["form", "bad", "good"])

    return rows.mapInArrow(run, "form long, bad long, good long")


def with_features(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield pa.record_batch([batch.column("toxic"), pa.array(list(features(model, batch.column("text"))), pa.list_(pa.float64()))], names=["toxic", "x"])

    return rows.mapInArrow(run, "toxic int, x array<double>")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with `toxicity` (0 to 1); a column of that name is replaced."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    rest = docs.select(*[c for c in docs.columns if c != "toxicity"])
    own = fresh("toxic_text", rest.columns)
    source = rest.withColumn(own, F.coalesce(F.col("text").cast("string"), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, own):
            score = 1 / (1 + np.exp(-np.clip(features(model, batch.column(own)) @ model.beta, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], schema=pa.schema([*list(batch.schema)[:-1], pa.field("toxicity", pa.float64())]))

    return source.mapInArrow(run, StructType([*rest.schema.fields, StructField("toxicity", DoubleType())]))


def kept(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows whose score is below the limit, with all their columns as they are; a row without a hit is never rejected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            x = features(model, batch.column("text"))
            score = 1 / (1 + np.exp(-np.clip(x @ model.beta, -30, 30)))
            yield batch.filter(pa.array((score < limit) | ~x[:, 1:].any(axis=1)))

    return docs.mapInArrow(run, docs.schema)


def fold(key: str = "doc_id", folds: int = 5):
    """The remainder of a document's CRC-32; a null key has remainder 1, so it is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(1))
