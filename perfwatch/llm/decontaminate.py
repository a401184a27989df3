"""Benchmark decontamination: BM25 over an inverted index of test items, block-max WAND, overlap check.

*Index.* Test items are the indexed side. Each (term, item) has a BM25 impact
divided by the item's own score, so an item scores 1 against itself. Items are
laid out in blocks of ``BLOCK`` neighbours; a term keeps its largest impact
over all items and over each block. The index is cut into shards of at most
``SHARD_ITEMS`` items, which bounds what a task holds; each shard is a pass of its
own. Items longer than half a passage are indexed in pieces.

*Search.* Every training text is cut into passages of ``PASSAGE`` words, each
starting half a passage after the one before, and every passage is a query.
Upper bounds come first: the sum of its terms' largest impacts, then of their
block maxima. Only blocks whose bound reaches the threshold are scored, and
all items that reach it are retrieved; the bounds never lose one. Passages of
many whole documents are bounded at once, in vectorised steps.

*Check.* A retrieved item is compared with the whole text by its runs of
``RUN`` words: the shares of the runs of the question and of the answer that
the text contains. A question or answer of fewer words than a run is there if
its words stand together within a passage of a run of the other part; if both are
that short, within a run of each other. Items that have only one text are
questions whose last sentence stands for the answer.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from perfwatch.llm import text as tx

PASSAGE, BLOCK, RUN = 128, 8, 4
RETRIEVE, QUESTION, ANSWER = 0.5, 0.6, 0.5
SHARD_ITEMS = 20_000
K1, B = 1.2, 0.75


@dataclass
class Shard:
    """A part of the index. ``terms`` is sorted; the postings of a term stand together."""

    items: np.ndarray
    item_of: np.ndarray
    terms: np.ndarray
    start: np.ndarray
    posting_item: np.ndarray
    impact: np.ndarray
    most: np.ndarray
    block_start: np.ndarray
    block: np.ndarray
    block_most: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    #: The words of questions and answers of fewer than RUN words, in order; none for other items.
    short: dict[int, tuple[np.ndarray, np.ndarray]]
    known: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of hashes in ``terms``, -1 for others."""
        out = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.known[(hashes >> np.uint64(44)).astype(np.int64)])
        if len(maybe) and len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, hashes[maybe]), len(self.terms) - 1)
            hit = self.terms[at] == hashes[maybe]
            out[maybe[hit]] = at[hit]
        return out


def _words(texts: list[str]) -> tx.Words:
    _, _, data, offsets = next(tx.slices(tx.pc.utf8_lower(pa.array(texts, pa.large_string())), 1 << 62))
    return tx.Words(data, offsets, tx.ALNUM)


def _runs(words: tx.Words) -> list[np.ndarray]:
    doc, h = tx.shingles(words, RUN)
    return [np.unique(x) for x in np.split(h, np.searchsorted(doc, np.arange(1, len(words.counts))))]


def _short(questions: tx.Words, answers: tx.Words) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The words of both parts of the items that have a part under RUN words, but RUN words in all."""
    n, m = questions.counts, answers.counts
    few = (np.minimum(n, m) > 0) & (np.minimum(n, m) < RUN) & (n + m >= RUN)
    return {int(i): tuple(w.hashes[w.first[i] : w.first[i] + w.counts[i]] for w in (questions, answers)) for i in np.flatnonzero(few)}


def _pieces(words: tx.Words) -> tuple[np.ndarray, np.ndarray]:
    """The piece of each word and the item of each piece: items over half a passage are cut into even pieces."""
    n = np.maximum(1, words.counts // (PASSAGE // 2))
    base = np.cumsum(n) - n
    within = np.arange(len(words.doc)) - np.repeat(words.first, words.counts)
    return base[words.doc] + within * n[words.doc] // np.maximum(words.counts, 1)[words.doc], np.repeat(np.arange(len(n)), n)


def _postings(items: list[tuple]) -> tuple:
    """Pieces, terms and counts of the distinct (piece, term); length and item of each piece."""
    words = _words([f"{q or ''}\n{a or ''}" for _, q, a in items])
    piece, item_of = _pieces(words)
    pairs, tf = np.unique(np.stack([piece.astype(np.uint64), words.hashes]), axis=1, return_counts=True)
    return pairs[0].astype(np.int64), pairs[1], tf, np.bincount(piece, minlength=len(item_of)), item_of


def build_shard(items: list[tuple], idf: dict[int, float], mean_length: float) -> Shard:
    """Index (id, question, answer) rows under corpus-wide idf values and mean length."""
    doc, term, tf, length, item_of = _postings(items)
    weight = np.array([idf[int(t)] for t in term]) if len(term) else np.zeros(0)
    impact = weight * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / mean_length))
    own = np.bincount(doc, impact, len(item_of))
    impact = impact / np.maximum(own[doc], 1e-12)
    order = np.lexsort((doc, term))
    doc, term, impact = doc[order], term[order], impact[order].astype(np.float32)
    terms, start = np.unique(term, return_index=True)
    cell = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (doc[1:] // BLOCK != doc[:-1] // BLOCK))) if len(term) else np.zeros(0, int)
    known = np.zeros(1 << 20, bool)
    known[(terms >> np.uint64(44)).astype(np.int64)] = True
    none = np.zeros(0, np.float32)
    questions, answers = _words([q or "" for _, q, _ in items]), _words([a or "" for *_, a in items])
    return Shard(
        items=np.array([i for i, *_ in items], object), item_of=item_of, terms=terms, start=np.append(start, len(term)), posting_item=doc, impact=impact,
        most=np.maximum.reduceat(impact, start) if len(term) else none,
        block_start=np.append(np.searchsorted(cell, start), len(cell)), block=doc[cell] // BLOCK,
        block_most=np.maximum.reduceat(impact, cell) if len(term) else none,
        question=_runs(questions), answer=_runs(answers), short=_short(questions, answers), known=known,
    )


def _expand(start: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions in the lists ``at`` of a table with list starts, and which of ``at`` each is from."""
    n = start[at + 1] - start[at]
    which = np.repeat(np.arange(len(at)), n)
    return start[at][which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n), which


def search(words: tx.Words, shard: Shard, least: float = RETRIEVE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item position, best passage score) of all items of which a passage retrieves a piece."""
    term = shard.find(words.hashes)
    half, first = PASSAGE // 2, words.first
    # Half passages are numbered through all documents; a passage is a half and the next one of its document.
    halves = np.maximum(1, -(-words.counts // half))
    base = np.cumsum(halves) - halves
    within = np.arange(len(term)) - np.repeat(first, words.counts)
    half_of = base[words.doc] + within // half
    total = int(halves.sum())
    has = term >= 0
    t, h = term[has], half_of[has]
    bound = np.bincount(h, shard.most[t], total)
    last = np.zeros(total, bool)
    last[base + halves - 1] = True
    after = np.where(last, 0.0, np.append(bound[1:], 0.0))
    passage = np.flatnonzero(bound + after >= least)
    none = np.zeros(0, np.int64)
    if not len(passage):
        return none, none, np.zeros(0)
    wanted = np.zeros(total + 1, bool)
    wanted[passage] = True
    wanted[passage[~last[passage]] + 1] = True
    use = wanted[h]
    # Distinct terms of each half, then of each passage.
    key = np.unique(h[use].astype(np.int64) * len(shard.terms) + t[use])
    h, t = key // len(shard.terms), key % len(shard.terms)
    doc_of_half = np.repeat(np.arange(len(halves)), halves)
    out = []
    blocks = int(shard.block.max(initial=0)) + 1
    step = max(1, (1 << 22) // max(1, blocks))
    for lo in range(0, len(passage), step):
        some = passage[lo : lo + step]
        rank = np.full(total + 1, -1)
        rank[some] = np.arange(len(some))
        here = rank[h]
        before = np.where((h > 0) & ~last[np.maximum(h - 1, 0)], rank[np.maximum(h - 1, 0)], -1)
        p, q = np.concatenate([here, before]), np.concatenate([t, t])
        key = np.unique(p[p >= 0].astype(np.int64) * len(shard.terms) + q[p >= 0])
        p, q = key // len(shard.terms), key % len(shard.terms)
        at, which = _expand(shard.block_start, q)
        cell = p[which] * blocks + shard.block[at]
        likely = np.bincount(cell, shard.block_most[at], len(some) * blocks) >= least - 1e-6
        if not likely.any():
            continue
        open_passages = likely.reshape(-1, blocks).any(axis=1)[p]
        p, q = p[open_passages], q[open_passages]
        at, which = _expand(shard.start, q)
        item = shard.posting_item[at]
        good = likely[p[which] * blocks + item // BLOCK]
        pair, place = np.unique(p[which][good] * len(shard.item_of) + item[good], return_inverse=True)
        score = np.bincount(place, shard.impact[at][good], len(pair))
        hit = score >= least - 1e-6
        piece = pair[hit] % len(shard.item_of)
        out.append((doc_of_half[some[pair[hit] // len(shard.item_of)]], shard.item_of[piece], score[hit]))
    if not out:
        return none, none, np.zeros(0)
    doc, item, score = (np.concatenate(x) for x in zip(*out, strict=True))
    pair, place = np.unique(doc * len(shard.items) + item, return_inverse=True)
    best = np.zeros(len(pair))
    np.maximum.at(best, place, score)
    return pair // len(shard.items), pair % len(shard.items), best


def _share(runs: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(runs, there).mean()) if len(runs) else -1.0


def _places(words: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Where the words of a part stand together in a text."""
    at = np.flatnonzero(words[: max(0, len(words) - len(part) + 1)] == part[0])
    for j in range(1, len(part)):
        at = at[words[at + j] == part[j]]
    return at


def _close(a: np.ndarray, a_words: int, b: np.ndarray, b_words: int, gap: int) -> bool:
    """Is a place of one part followed by one of the other after at most ``gap`` words, either one first?"""

    def follows(x: np.ndarray, length: int, y: np.ndarray) -> bool:
        after = np.append(y, np.iinfo(np.int64).max)[np.searchsorted(y, x + length)]
        return bool((after - x - length <= gap).any())

    return bool(len(a) and len(b)) and (follows(a, a_words, b) or follows(b, b_words, a))


def _short_shares(q: float, a: float, parts: tuple[np.ndarray, np.ndarray], words: np.ndarray, runs: np.ndarray, shard: Shard, item: int) -> tuple[float, float]:
    """The shares with 0 or 1 for each part under RUN words; ``runs`` are those of the text in order."""
    question, answer = parts
    if len(question) < RUN and len(answer) < RUN:
        there = _close(_places(words, question), len(question), _places(words, answer), len(answer), RUN)
        return float(there), float(there)
    if len(answer) < RUN:
        near = _close(np.flatnonzero(np.isin(runs, shard.question[item])), RUN, _places(words, answer), len(answer), PASSAGE)
        return q, float(near)
    near = _close(np.flatnonzero(np.isin(runs, shard.answer[item])), RUN, _places(words, question), len(question), PASSAGE)
    return float(near), a


def leaks_in(column: pa.Array, shard: Shard, least: float, question: float, answer: float):
    """(row, item position, score, question share, answer share) of verified leaks."""
    for low, _, data, offsets in tx.slices(tx.pc.utf8_lower(column)):
        words = tx.Words(data, offsets, tx.ALNUM)
        doc, item, score = search(words, shard, least)
        if not len(doc):
            continue
        of, h = tx.shingles(words, RUN)
        edges = np.searchsorted(of, np.arange(len(words.counts) + 1))
        runs: dict[int, np.ndarray] = {}
        for d, i, s in zip(doc, item, score, strict=True):
            if d not in runs:
                runs[d] = np.unique(h[edges[d] : edges[d + 1]])
            q, a = _share(shard.question[i], runs[d]), _share(shard.answer[i], runs[d])
            if i in shard.short:
                here = words.hashes[words.first[d] : words.first[d] + words.counts[d]]
                q, a = _short_shares(q, a, shard.short[i], here, h[edges[d] : edges[d + 1]], shard, i)
            if (q >= question or q < 0) and (a >= answer or a < 0) and max(q, a) >= 0:
                yield low + int(d), int(i), float(s), max(q, 0.0), None if a < 0 else a


def split_item(text: str) -> tuple[str, str | None]:
    """Question and answer of an item with one text: the last sentence is the answer if it has RUN words."""
    # Words are counted as runs count them.
    cut = max(text.rstrip(" .\n").rfind(". "), text.rstrip(" .\n").rfind(".\n"))
    question, answer = text[: cut + 1], text[cut + 1 :]
    if cut < 0 or _words([question, answer]).counts.min() < RUN:
        return text, None
    return question, answer


def index(items: DataFrame, shard_items: int = SHARD_ITEMS) -> list[Shard]:
    """The index of ``items`` (item_id and text, or item_id, question and answer).

    Items with no word are left out; a null answer is none. The test set is
    the small side by nature: it is read shard by shard in the order of its
    ids, and each shard is bounded. Document frequencies cover all items.
    Items under RUN words can't be told from chance and are never reported.
    """
    columns = ["item_id", "question", "answer"] if "question" in items.columns else ["item_id", "text"]
    rows = [tuple(r) if len(r) == 3 else (r[0], *split_item(r[1] or "")) for r in items.select(*columns).orderBy(*columns).toLocalIterator()]
    rows = [r for r in rows if _words([f"{r[1] or ''} {r[2] or ''}"]).counts[0]]
    df: dict[int, int] = {}
    length = pieces = 0
    for lo in range(0, len(rows), shard_items):
        _, terms, _, lengths, item_of = _postings(rows[lo : lo + shard_items])
        length, pieces = length + int(lengths.sum()), pieces + len(item_of)
        for t, n in zip(*np.unique(terms, return_counts=True), strict=True):
            df[int(t)] = df.get(int(t), 0) + int(n)
    idf = {t: float(np.log1p((pieces - n + 0.5) / (n + 0.5))) for t, n in df.items()}
    return [build_shard(rows[lo : lo + shard_items], idf, max(1.0, length / max(1, pieces))) for lo in range(0, len(rows), shard_items)]


def leaks(
    docs: DataFrame, items: DataFrame, least: float = RETRIEVE, question: float = QUESTION, answer: float = ANSWER
) -> DataFrame:
    """doc_id, item_id, score, question_share, answer_share (null without an answer) of every leak.

    One row per row of ``docs`` and leaked item. Null and empty texts have no
    passage and leak nothing; texts under a passage are one passage; repeated
    rows are found alike; equal items are each found. Without items or
    documents the result is empty. Other columns are ignored.
    """
    id_type, item_type = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("item_id", item_type), T.StructField("score", T.DoubleType()),
        T.StructField("question_share", T.DoubleType()), T.StructField("answer_share", T.DoubleType()),
    ])
    arrow = pa.int64() if isinstance(item_type, T.LongType) else pa.int32() if isinstance(item_type, T.IntegerType) else pa.string()

    def run_with(shard):
        def run(batches):
            for batch in batches:
                found = list(leaks_in(batch.column("text"), shard, least, question, answer))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())),
                    pa.array([shard.items[f[1]] for f in found], arrow), pa.array([f[2] for f in found], pa.float64()),
                    pa.array([f[3] for f in found], pa.float64()), pa.array([f[4] for f in found], pa.float64()),
                ], names=schema.names)

        return run

    read = docs.select("doc_id", "text")
    passes = [read.mapInArrow(run_with(shard), schema) for shard in index(items)]
    return reduce(DataFrame.union, passes) if passes else docs.sparkSession.createDataFrame([], schema)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text leaks no item, unchanged."""

    def keep_with(shard):
        def keep(batches):
            for batch in batches:
                clean = np.ones(len(batch), bool)
                clean[[f[0] for f in leaks_in(batch.column("text"), shard, RETRIEVE, QUESTION, ANSWER)]] = False
                yield batch.filter(pa.array(clean))

        return keep

    return reduce(lambda kept, shard: kept.mapInArrow(keep_with(shard), kept.schema), index(items), docs)
