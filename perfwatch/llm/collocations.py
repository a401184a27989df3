"""Phrase collocations from mergeable Misra-Gries summaries.

*First passes.* Every phrase belongs to a hash partition. A summary of a
partition holds more counters than the partition's occurrences divided by the
threshold. When it overflows, the count just beyond its capacity is taken from
all counters and those at zero go. Each such step of size d takes more than
capacity times d occurrences away, so over all summaries of a partition, merged
in any order, less than the threshold is lost from any phrase: every frequent
phrase keeps a counter. Words come first, then pairs of surviving words, then
longer phrases all of whose pairs survive (a frequent phrase has only frequent
parts). Survivors of earlier levels are looked up in a bitmap of fixed size;
its false hits, or a full bitmap, cost work and lose nothing.

*Second pass.* Occurrences of surviving phrases are counted exactly, by their
words, and scores are decimal arithmetic.

Texts are read in whole pieces, a megabyte at a time; only counts summed within
a task are shuffled, packed by hash partition, so a word that is a third of all
words is one entry of each task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from perfwatch.llm import text as tx
from perfwatch.session import stage

LONGEST, LEAST, WITHIN, TOP = 5, 100, 100, 2000
#: Occurrences of a hash partition, about; its summary has a hundredth of it in counters at a threshold of 100.
MASS = 1_000_000
BYTES_A_WORD = 4
#: Bits of the bitmap of surviving phrases (4 MB); a fixed bound of what is sent to tasks.
FILTER_BITS = 1 << 25
#: Partial counts that a task holds before it passes them on.
HELD = 1 << 19
#: Each phrase sets two bits, taken from these places of its hash. Counters are kept by the 48 bits that both
#: have; phrases that share them share a counter, which loses none. The exact pass uses whole hashes and words.
_SHIFTS = 0, 23
_KEPT = np.uint64((1 << 48) - 1)

_IS_SEPARATOR = np.array([chr(b) in ".,;:!?" or 0x0A <= b <= 0x0D for b in range(256)])
_IS_WORD = ~_IS_SEPARATOR & np.array([b not in (0x20, 0x09) for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_PLACES = tx.mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def _runs(column: pa.Array):
    """Runs of ``text.slices``; a longer document is cut behind separators, where no phrase ends."""
    for row, to, data, offsets in tx.slices(column):
        if len(data) <= 2 * tx.SLICE_BYTES:
            yield row, to, data, offsets
            continue
        cuts = np.flatnonzero(_IS_SEPARATOR[data]) + 1
        at = 0
        while at < len(data):
            i = np.searchsorted(cuts, at + tx.SLICE_BYTES)
            end = int(cuts[i]) if i < len(cuts) else len(data)
            yield row, to, data[at:end], np.array([0, end - at])
            at = end


class _Grams:
    """The phrases of a run of documents: hashes by length, in the order of their first words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        self.data = _LOWER[data]
        self.words = tx.Words(self.data, offsets, _IS_WORD)
        self.piece = np.cumsum(_IS_SEPARATOR[self.data])[self.words.start] if len(self.words.start) else np.zeros(0, np.int64)
        self.lang = langs[self.words.doc]
        self.parts: dict[int, np.ndarray] = {}

    def hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the n words from each word on, whether they stand in one piece)."""
        words, size = self.words, max(0, len(self.words.hashes) - n + 1)
        total = np.zeros(size, np.uint64)
        for j in range(n):
            total += words.hashes[j : j + size] * _PLACES[j]
        whole = (words.doc[:size] == words.doc[n - 1 :][:size]) & (self.piece[:size] == self.piece[n - 1 :][:size])
        return tx.mix(total + self.lang[:size] * _PLACES[63 - n]), whole

    def open(self, n: int, bits: np.ndarray | None) -> np.ndarray:
        """Whether all parts of one and two words of the n words from each word on have survived."""
        size = max(0, len(self.words.hashes) - n + 1)
        good = np.ones(size, bool)
        for part in (1, 2):
            if bits is not None and part < n:
                if part not in self.parts:
                    h, whole = self.hashes(part)
                    self.parts[part] = whole & _known(bits, h) & self.open(part, bits)
                for j in range(n - part + 1):
                    good &= self.parts[part][j : j + size]
        return good

    def phrase(self, at: int, n: int) -> bytes:
        words = self.words
        return b" ".join(self.data[words.start[i] : words.end[i]].tobytes() for i in range(at, at + n))


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set."""
    known = np.ones(len(hashes), bool)
    for shift in _SHIFTS:
        place = hashes >> np.uint64(shift) & np.uint64(FILTER_BITS - 1)
        known &= (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return known


def _lang_hashes(langs: list[str]) -> np.ndarray:
    codes = {lang: np.frombuffer((lang.encode() + b"\0" * 8)[: (len(lang.encode()) + 8) // 8 * 8], np.uint64) for lang in set(langs)}
    values = {}
    for lang, parts in codes.items():
        value = np.array([len(lang) + 1], np.uint64)
        for part in parts:
            value = tx.mix(value * _PLACES[0] ^ part)
        values[lang] = value[0]
    return np.array([values[lang] for lang in langs], np.uint64)


def _together(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h = h[order]
    first = np.flatnonzero(np.append(len(h) > 0, h[1:] != h[:-1]))
    return h[first], np.add.reduceat(c[order], first) if len(first) else c


def _packed(p: np.ndarray, h: np.ndarray, c: np.ndarray, least: int, lost: dict[int, int] | None = None) -> pa.RecordBatch:
    """One row for each partition, its hashes and counts as bytes; ``light`` sums the counts under ``least``."""
    order = np.argsort(p, kind="stable")
    p, h, c = p[order], h[order], c[order].astype(np.int64)
    lost = lost or {}
    parts = np.union1d(p, np.array(list(lost), np.int64))
    edges = np.searchsorted(p, parts), np.searchsorted(p, parts, "right")
    spans = list(zip(*edges, strict=True))
    six = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    short = np.minimum(c, (1 << 32) - 1).astype("<u4")
    columns = (
        pa.array(parts), pa.array([six[x:y].tobytes() for x, y in spans], pa.binary()), pa.array([short[x:y].tobytes() for x, y in spans], pa.binary()),
        pa.array([int(c[x:y][c[x:y] < least].sum()) for x, y in spans], pa.int64()), pa.array([lost.get(int(x), 0) for x in parts], pa.int64()),
    )
    return pa.RecordBatch.from_arrays(list(columns), names=["p", "h", "c", "light", "lost"])


_PACKED = "p long, h binary, c binary, light long, lost long"


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, c = (b"".join(batch.column(i).to_pylist()) for i in ("h", "c"))
    counts = np.frombuffer(c, "<u4").astype(np.int64)
    hashes = np.zeros((len(counts), 8), np.uint8)
    hashes[:, :6] = np.frombuffer(h, np.uint8).reshape(-1, 6)
    sizes = np.array([len(x) // 4 for x in batch.column("c").to_pylist()], np.int64)
    return np.repeat(batch.column("p").to_numpy(), sizes), hashes.view("<u8").ravel(), counts


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


def _partial(lengths: tuple[int, ...], bits: np.ndarray | None, parts: int, least: int):
    """Counts of phrases of these lengths whose shorter parts survive, summed within a task, by hash partition."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        for batch in batches:
            langs = _lang_hashes(batch.column("lang").to_pylist())
            for row, to, data, offsets in _runs(batch.column("text")):
                grams = _Grams(data, offsets, langs[row:to])
                for n in lengths:
                    h, whole = grams.hashes(n)
                    values, counts = np.unique(h[whole & grams.open(n, bits)] & _KEPT, return_counts=True)
                    held.append((values, counts.astype(np.int64)))
                    rows += len(values)
                if rows > HELD:
                    held = [_together(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                    rows = len(held[0][0])
                    if rows > HELD // 2:
                        yield _packed(_part(held[0][0], parts), *held[0], least)
                        held, rows = [], 0
        if held:
            h, c = _together(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield _packed(_part(h, parts), h, c, least)

    return run


class Summary:
    """Misra-Gries summaries of hash partitions.

    ``p, h, c`` are the counters, at most ``capacity`` in a partition, ``lost``
    what was taken from each counter of a partition at most.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.p, self.h, self.c = (np.zeros(0, t) for t in (np.int64, np.uint64, np.int64))
        self.lost: dict[int, int] = {}

    def add(self, p: np.ndarray, h: np.ndarray, c: np.ndarray) -> None:
        """Merge counters: sum equal ones, then take the first count beyond the capacity from all of an overfull partition."""
        p, h, c = np.concatenate([self.p, p]), np.concatenate([self.h, h]), np.concatenate([self.c, c])
        if not len(p):
            return
        order = np.lexsort((h, p))
        p, h, c = p[order], h[order], c[order]
        first = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (h[1:] != h[:-1])))
        p, h, c = p[first], h[first], np.add.reduceat(c, first)
        starts = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        sizes = np.diff(np.append(starts, len(p)))
        for lo, size in zip(starts[sizes > self.capacity], sizes[sizes > self.capacity], strict=True):
            over = c[lo : lo + size]
            taken = int(np.partition(over, size - self.capacity - 1)[size - self.capacity - 1])
            over -= taken
            if taken:
                self.lost[int(p[lo])] = self.lost.get(int(p[lo]), 0) + taken
        kept = c > 0
        self.p, self.h, self.c = p[kept], h[kept], c[kept]


def _summaries(capacity: int, least: int, final: bool):
    """Summaries of packed counts; with ``final`` the hashes (h) of the phrases that may reach ``least``.

    A count that reaches ``least`` by itself needs no counter and passes at once.
    """
    def run(batches):
        summary, held, rows, sure = Summary(capacity), [], 0, []

        def merge():
            summary.add(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()

        for batch in batches:
            for x, n in zip(batch.column("p").to_pylist(), batch.column("lost").to_pylist(), strict=True):
                if n:
                    summary.lost[x] = summary.lost.get(x, 0) + n
            p, h, c = _unpacked(batch)
            light = c < least
            sure.append((p[~light], h[~light], c[~light]))
            held.append((p[light], h[light], c[light]))
            rows += len(p)
            if rows > HELD:
                merge()
                rows = 0
        if held:
            merge()
        p, h, c = summary.p, summary.h, summary.c
        if final:
            lost = np.array([summary.lost.get(x, 0) for x in p.tolist()], np.int64)
            found = np.concatenate([h[c + lost >= least], *(x[1] for x in sure)])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(found).view(np.int64))], names=["h"])
            return
        columns = [np.concatenate(x) for x in zip((p, h, c), *sure, strict=True)]
        yield _packed(*columns, least, summary.lost)

    return run


def survivors(partial: DataFrame, least: int = LEAST) -> DataFrame:
    """(h) of every phrase whose counts in ``partial`` (packed and stored) sum to ``least`` or more, and of some others.

    Counts under ``least`` alone take part in summaries, so no partition
    outweighs the others by one phrase.
    """
    largest = partial.groupBy("p").agg(F.sum("light").alias("mass")).agg(F.max("mass")).first()[0] or 0
    capacity = largest // least + 1
    local = partial.mapInArrow(_summaries(capacity, least, False), _PACKED)
    return local.repartition("p").mapInArrow(_summaries(capacity, least, True), "h long")


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of ``hashes``, summed by word on the executors: FILTER_BITS / 64 rows at most."""
    places = hashes.select(F.explode(F.array(*(F.shiftrightunsigned("h", i).bitwiseAND(FILTER_BITS - 1) for i in _SHIFTS))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    ).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits.view(np.uint8)


def _exact(longest: int, bits: np.ndarray, parts: int):
    """Surviving phrases counted within a task: a row for each hash partition and language.

    ``phrases`` are joined by line ends, which no phrase holds. The empty one stands for all words.
    """
    def run(batches):
        found: dict[int, list] = {}
        words: dict[str, int] = {}

        def flush():
            rows = [(0, lang, b"", [n]) for lang, n in words.items()]
            grouped: dict[tuple[int, str], tuple[list[bytes], list[int]]] = {}
            values = np.fromiter(found, np.uint64, len(found))
            for p, (lang, phrase, n) in zip(_part(values, parts).tolist(), found.values(), strict=True):
                phrases, counts = grouped.setdefault((p, lang), ([], []))
                phrases.append(phrase)
                counts.append(n)
            rows += [(p, lang, b"\n".join(phrases), counts) for (p, lang), (phrases, counts) in grouped.items()]
            found.clear()
            words.clear()
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            types = pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["p", "lang", "phrases", "counts"])

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            hashed = _lang_hashes(langs)
            for row, to, data, offsets in _runs(batch.column("text")):
                grams = _Grams(data, offsets, hashed[row:to])
                for i, n in enumerate(grams.words.counts.tolist()):
                    words[langs[row + i]] = words.get(langs[row + i], 0) + n
                for n in range(1, longest + 1):
                    h, whole = grams.hashes(n)
                    at = np.flatnonzero(whole & _known(bits, h) & grams.open(n, bits))
                    values, first, counts = np.unique(h[at], return_index=True, return_counts=True)
                    for value, i, count in zip(values.tolist(), at[first].tolist(), counts.tolist(), strict=True):
                        if value in found:
                            found[value][2] += count
                        else:
                            found[value] = [langs[row + int(grams.words.doc[i])], grams.phrase(i, n), count]
                if len(found) > HELD // 2:
                    yield flush()
        yield flush()

    return run


def _added(least: int):
    """(lang, phrase, size, a): the sums of such counts, for phrases with ``least`` or more and for all words (size 0)."""
    def run(batches):
        sums: dict[str, dict[bytes, int]] = {}
        for batch in batches:
            for lang, phrases, counts in zip(*(batch.column(i).to_pylist() for i in ("lang", "phrases", "counts")), strict=True):
                own = sums.setdefault(lang, {})
                for phrase, n in zip(phrases.split(b"\n"), counts, strict=True):
                    own[phrase] = own.get(phrase, 0) + n
        rows = [
            (lang, phrase.decode("utf-8", "replace"), phrase.count(b" ") + 1 if phrase else 0, n)
            for lang, own in sums.items() for phrase, n in own.items() if n >= least or not phrase
        ]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        types = pa.string(), pa.string(), pa.int32(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "phrase", "size", "a"])

    return run


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, mass: int = MASS) -> DataFrame:
    """(lang, phrase, size, a): all phrases of 1 to ``longest`` words that occur ``least`` times or more in a language, exactly.

    A row of size 0 and an empty phrase has the words of each language.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    parts = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // (BYTES_A_WORD * mass)
    bits = None
    for lengths in [x for x in ((1,), (2,), tuple(range(3, longest + 1))) if x and max(x) <= longest]:
        partial = stage(texts.mapInArrow(_partial(lengths, bits, parts, least), _PACKED), "grams")
        found = _bitmap(survivors(partial, least))
        bits = found if bits is None else bits | found
    counted = texts.mapInArrow(_exact(longest, bits, parts), "p long, lang string, phrases binary, counts array<long>")
    return counted.repartition("p").mapInArrow(_added(least), "lang string, phrase string, size int, a long")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, within: int = WITHIN, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has text and lang. A-Z are lower-cased, texts are cut at
    ``.,;:!?`` and line ends, and words at spaces and tabs. A phrase of 2 to
    ``longest`` words with ``least`` occurrences or more is a candidate. It
    scores floor(1000 a n / (l r)) at its weakest cut, and falls out if a
    longer candidate that holds it occurs ``within`` percent as often. Ties go
    by a, then by the phrase's bytes. Null texts are empty, a null language is
    ``und``, repeated rows count again, other columns are ignored, and an empty
    table gives an empty result.
    """
    known = stage(frequent_phrases(docs, longest, least), "phrases")
    totals = known.filter("size = 0").select("lang", F.col("a").alias("n"))
    phrases = known.filter("size > 0")
    chosen = phrases.filter("size > 1").withColumn("words", F.split("phrase", " "))

    def part(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    cuts = chosen.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "k", part(F.lit(1), F.col("k")).alias("front"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("back")
    )
    fronts = phrases.select("lang", F.col("phrase").alias("front"), F.col("a").alias("l"))
    backs = phrases.select("lang", F.col("phrase").alias("back"), F.col("a").alias("r"))
    score = F.expr(
        "(1000 * cast(a AS decimal(20,0)) * cast(n AS decimal(20,0))) div (cast(l AS decimal(20,0)) * cast(r AS decimal(20,0)))"
    )
    scored = (
        cuts.join(fronts, ["lang", "front"]).join(backs, ["lang", "back"]).join(totals, "lang")
        .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    )
    held = (
        chosen.filter("size > 2").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
        .select("lang", part(F.col("start"), F.col("length")).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    alone = scored.join(held, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    return (
        alone.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
