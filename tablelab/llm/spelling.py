"""Grouping of spelling variants: words one edit apart, found in FM-indexes of the vocabulary.

An edit leaves the first or the second half of a word as it is. A search
matches one half exactly from its end of the word and goes on across the other
half, where one symbol may be added, left out or replaced. Both searches keep
an interval of suffix ranks over the delimited vocabulary: the first extends to
the right, in the index of the reversed words, the second to the left, in the
index of the words as they are. These are the two sides of a bidirectional
index; no search changes its direction.

Spread over tasks, each side is a range partition of the vocabulary: by the
words for the first search, by the reversed words for the second. A shard
indexes its own words. Words with an equal half stand next to each other, so a
word is sought in its own shard and, where the range of its half reaches over
shard ends, in the shards there. A shard with many such visitors is dealt out
as several tasks with the same index. Tasks return one row per word and shard,
never pairs.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from math import ceil, floor, log2, log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.llm.common import chunks, pick, stored

LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is at least so many times as frequent as its variant.
TIMES = 10
#: One in so many (document, word) cases loses a code point.
EVERY = 31
#: Words that a shard indexes, about.
SHARD_WORDS = 50_000
#: Words sampled for each shard to find the ends of the shards, and their code points that count.
SAMPLED, END_POINTS = 64, 24
#: Words sought together.
SOUGHT = 8192
#: Distinct words that a counting task holds before it hands them on.
HELD = 200_000

_LOWER = {c: c + 32 for c in range(65, 91)}
_LAST = "\U0010ffff"


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, every: int = EVERY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: maximal runs of letters in A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case.

    Where ``every`` divides the crc32 h of ``<doc_id>:<run>``, the run loses its
    code point number h % length. A null doc_id counts as an empty one.
    """
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_length)

    def count(batches):
        held: Counter[str] = Counter()
        for batch in chunks(batches):
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                start = zlib.crc32(f"{i or ''}:".encode())
                for run, n in Counter(runs.findall((t or "").translate(_LOWER))).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_length:
                            continue
                    held[run] += n
            if len(held) > HELD:
                yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())}, schema)
                held = Counter()
        yield pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())}, schema)

    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    counted = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class RankIndex:
    """FM-index of reversed words, each closed by a delimiter; searches extend words to the right.

    Suffixes are ranked up to their delimiter, equal ones by their place. The
    keys ``symbol * size + rank`` of the symbols before all suffixes, in order,
    hold the usual counts: the place of a key is the rank that a backward step
    leads to.
    """

    def __init__(self, words: list[str]):
        lengths = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.alphabet = np.unique(points)
        starts = np.cumsum(lengths + 1) - lengths - 1
        self.words, self.size = len(words), int((lengths + 1).sum())
        ends = starts + lengths
        text = np.zeros(self.size, np.int64)
        text[np.repeat(ends - 1 + np.cumsum(lengths) - lengths, lengths) - np.arange(len(points))] = np.searchsorted(self.alphabet, points) + 1
        self.word_at = np.repeat(np.arange(len(words)), lengths + 1)
        rank, place, end, step, kinds = text, np.arange(self.size), ends[self.word_at], 1, -1
        while step <= int(lengths.max(initial=0)) * 2:
            later = place + step
            then = np.where(later <= end, rank[np.minimum(later, self.size - 1)] + 1, 0)
            found, rank = np.unique(rank * (self.size + 2) + then, return_inverse=True)
            if len(found) == kinds:
                break
            kinds, step = len(found), step * 2
        self.suffixes = np.argsort(rank, kind="stable")
        before = text[self.suffixes - 1]
        self.before = before
        self.places = np.argsort(before, kind="stable")
        self.keys = before[self.places] * self.size + self.places

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; those that no word holds get one that leads nowhere."""
        at = np.searchsorted(self.alphabet, points)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == points[known]
        return np.where(known, at + 1, len(self.alphabet) + 1)

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = symbol * self.size
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For every interval and every symbol that goes on from it: number of the interval, symbol, its interval."""
        both, at = np.unique(low * (self.size + 1) + high, return_inverse=True)
        from_, to = both // (self.size + 1), both % (self.size + 1)
        wide = to - from_
        rows = np.arange(int(wide.sum())) + np.repeat(from_ - (np.cumsum(wide) - wide), wide)
        kinds = len(self.alphabet) + 1
        pairs = np.unique(np.repeat(np.arange(len(both)), wide) * kinds + self.before[rows])
        of, symbol = pairs // kinds, pairs % kinds
        of, symbol = of[symbol > 0], symbol[symbol > 0]
        next_low, next_high = self.step(symbol, from_[of], to[of])
        number = np.bincount(of, minlength=len(both))
        first = np.cumsum(number) - number
        repeat = number[at]
        pick_ = np.arange(int(repeat.sum())) + np.repeat(first[at] - (np.cumsum(repeat) - repeat), repeat)
        return np.repeat(np.arange(len(low)), repeat), symbol[pick_], next_low[pick_], next_high[pick_]

    def near(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number among ``words``, number of an indexed word) one edit apart that share the first ``exact`` code points.

        Of equal edits (in a run of one symbol) only the last one is followed, so a pair comes up once.
        """
        length = np.array([len(w) for w in words], np.int64)
        start = np.cumsum(length) - length
        pattern = np.append(self.symbols(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)), -1)

        def ahead(word, at, by=0):
            """The symbol ``by`` places on, -1 behind the end."""
            return np.where(at + by < length[word], pattern[np.minimum(start[word] + at + by, len(pattern) - 1)], -1)

        word = np.arange(len(words))
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.words, np.int64)
        for t in range(int(exact.max(initial=0))):
            on = exact[word] > t
            low[on], high[on] = self.step(ahead(word[on], t), low[on], high[on])
            some = low < high
            word, low, high = word[some], low[some], high[some]
        right = (word, exact[word], low, high)
        wrong = tuple(np.zeros(0, np.int64) for _ in range(4))
        out = []
        while len(right[0]) or len(wrong[0]):
            word, at, low, high = wrong
            closed = at == length[word]
            delimiter = np.zeros(int(closed.sum()), np.int64)
            first, last = self.step(delimiter, low[closed], high[closed])
            hit = first < last
            out.append((word[closed][hit], self.word_at[self.suffixes[self.places[first[hit]]]]))
            word, at, low, high = (x[~closed] for x in wrong)
            low, high = self.step(ahead(word, at), low, high)
            some = low < high
            parts = [(word[some], at[some] + 1, low[some], high[some])]
            word, at, low, high = right
            next_ = ahead(word, at)
            dropped = (next_ >= 0) & (next_ != ahead(word, at, 1))
            parts.append((word[dropped], at[dropped] + 1, low[dropped], high[dropped]))
            of, symbol, low, high = self.branches(low, high)
            other = symbol != next_[of]
            added = (word[of][other], at[of][other], low[other], high[other])
            inside = next_[of][other] >= 0
            parts += [added, tuple(x[inside] + (i == 1) for i, x in enumerate(added))]
            wrong = tuple(np.concatenate(x) for x in zip(*parts))
            right = (word[of][~other], at[of][~other] + 1, low[~other], high[~other])
        return np.concatenate([o[0] for o in out] or [np.zeros(0, np.int64)]), np.concatenate([o[1] for o in out] or [np.zeros(0, np.int64)])


def _ends(words: DataFrame, size: int, shard_words: int) -> list[list[str]]:
    """For both sides: the first words of all shards but the first, shortened; about one per ``shard_words`` words."""
    shards = ceil(size / shard_words)
    if shards < 2:
        return [[], []]
    one_in = max(1, size // (shards * SAMPLED))
    some = words.where(F.pmod(F.xxhash64("word"), F.lit(one_in)) == 0)
    out = []
    for side in (F.col("word"), F.reverse("word")):
        held = sorted(r[0] for r in some.select(F.substring(side, 1, END_POINTS)).collect())
        out.append(sorted({held[len(held) * i // shards] for i in range(1, shards)}) if held else [])
    return out


def _half(side: int, word: str) -> int:
    """Code points of the half that a side matches exactly, the word read in the side's direction."""
    return len(word) // 2 if side == 0 else len(word) - len(word) // 2


def _places(ends: list[list[str]], word: str):
    """(side, own shard, shards to be searched) for both sides."""
    for side in (0, 1):
        read = word if side == 0 else word[::-1]
        half = read[: _half(side, word)]
        yield side, bisect_right(ends[side], read), range(bisect_right(ends[side], half), bisect_right(ends[side], half + _LAST) + 1)


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, n_near, best (n, word): for words with words one edit apart; ``words`` (word, n) is stored and without repeats."""
    size = words.count()
    ends = _ends(words, size, shard_words)
    shards = [len(e) + 1 for e in ends]

    def visit(batches):
        seen: Counter[int] = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                for side, _, searched in _places(ends, word):
                    seen.update(side * shards[0] + s for s in searched)
        yield pa.RecordBatch.from_pydict({"shard": pa.array(list(seen), pa.int32()), "n": pa.array(list(seen.values()), pa.int64())})

    visits = words.select("word").mapInArrow(visit, "shard int, n long").groupBy("shard").agg(F.sum("n").alias("n"))
    # One row per shard.
    copies = np.ones(sum(shards), np.int64)
    for r in visits.collect():
        copies[r["shard"]] = max(1, ceil(r["n"] / (2 * shard_words)))
    first = (np.cumsum(copies) - copies).tolist()
    copies, tasks = copies.tolist(), int(copies.sum())

    def deal(batches):
        for batch in batches:
            rows: list[tuple] = []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                turn = zlib.crc32(word.encode())
                for side, own, searched in _places(ends, word):
                    for s in {own, *searched}:
                        k = side * shards[0] + s
                        mine = turn % copies[k] if s in searched else -1
                        for c in range(copies[k]) if s == own else [mine]:
                            rows.append((first[k] + c, side, s == own, c == mine, word, n))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 6, (pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.int64()))], names=["task", "side", "held", "sought", "word", "n"])

    dealt = words.select("word", "n").mapInArrow(deal, "task int, side int, held boolean, sought boolean, word string, n long")

    def search(batches):
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        got = pa.Table.from_batches(rows)
        task = set(got.column("task").unique().to_pylist())
        if task != {TaskContext.get().partitionId()}:
            raise AssertionError(f"tasks {task} in one partition")
        side = got.column("side")[0].as_py()
        held = got.filter(got.column("held"))
        known, counts = held.column("word").to_pylist(), held.column("n").to_numpy()
        if not known:
            return
        turned = (lambda w: w) if side == 0 else (lambda w: w[::-1])
        index = RankIndex([turned(w) for w in known])
        order = np.empty(len(known), np.int64)
        order[sorted(range(len(known)), key=known.__getitem__)] = np.arange(len(known))
        sought = sorted(map(turned, got.filter(got.column("sought")).column("word").to_pylist()))
        for low in range(0, len(sought), SOUGHT):
            some = sought[low : low + SOUGHT]
            a, b = index.near(some, np.array([_half(side, w) for w in some], np.int64))
            if side:  # pairs with an equal first half are the other side's
                own = [w[::-1] for w in some]
                kept = np.array([not known[j].startswith(own[i][: len(own[i]) // 2]) for i, j in zip(a.tolist(), b.tolist())], bool)
                a, b = a[kept], b[kept]
            if not len(a):
                continue
            by = np.lexsort((order[b], -counts[b], a))
            a, b = a[by], b[by]
            heads = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([turned(some[i]) for i in a[heads].tolist()], pa.string()), pa.array(np.diff(np.append(heads, len(a)))),
                 pa.array(counts[b[heads]]), pa.array([known[j] for j in b[heads].tolist()], pa.string())],
                names=["word", "n_near", "best_n", "best"],
            )

    found = dealt.repartitionById(tasks, F.col("task")).mapInArrow(search, "word string, n_near long, best_n long, best string")
    # Few rows per word: one for each shard in which it has near words.
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best"))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """word, root: ``forms`` (word, form) followed to the end.

    A form is at least TIMES as frequent as its word, so a chain has at most
    log(most / LEAST_COUNT) steps; their number doubles with each join.
    """
    steps = max(1, floor(log10(max(most, 2) / LEAST_COUNT) / log10(TIMES)) + 1)
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ceil(log2(steps))):
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = stored(found.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return found


def group_variants(docs: DataFrame, shard_words: int = SHARD_WORDS, least_count: int = LEAST_COUNT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    Null and empty texts hold no words; rows that repeat an id count each for
    itself. Without words the result is empty.
    """
    words = stored(count_words(docs, doc_id=doc_id, text=text).where(F.col("n") >= least_count), "words")
    most = words.agg(F.max("n")).first()[0] or 0
    near = near_words(words, shard_words)
    takes = -F.col("best.less") >= TIMES * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(takes, F.col("best.word")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n")
    )
    joined = stored(joined, "forms")
    roots = _roots(joined.where("form IS NOT NULL"), most)
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
