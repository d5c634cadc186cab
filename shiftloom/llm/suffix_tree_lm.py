"""Language-model scores from a probabilistic suffix tree over all words of the corpus.

Tokens are a text's words (A-Z lower-cased) and one end. A state of the tree is a context, the words before a
token, of up to ``DEPTH`` words (the third by an 8-bit class of its hash). A context is retained if its next-token distribution
diverges from that of its longest retained shorter context: count * KL >= ``gain`` * count + log2(training tokens), in bits, so
a context met once never is, and one met twice is where what follows it is rare elsewhere. A distribution is smoothed with the
shorter context's by as many pseudo-tokens as it has different next tokens (Witten and Bell), times ``prior``. A token is scored from its longest
retained context, so every text has a probability.

Counting and scoring are one pass over the corpus. Each token travels as one record (the words before it, the token,
its row) to the bin of its nearest word; there lie all records of every context that ends in that word, so contexts of all depths are
counted, tested and looked up in that bin, for all words of the corpus: what is gathered grows with the input. A word that would fill a bin
(a share of ``P_HOT`` of all tokens or more) is dealt by two words instead, a pair that would by three; such frequent contexts (at most
2 / P_HOT) are counted by partial sums over the frequent words (at most 1 / P_HOT, other words as one class) and broadcast as the upper
part of the tree. Words of a share of 1 / ``CODES`` or more are written as 16-bit numbers; other words as hashes, and where no context knows them
they share their part of the probability evenly. Bins return sums a row.

Defined cases: null text is empty (one end token); a null id trains and is never held out; repeated
rows count and score as rows of their own; an empty training set scores with N = V = 0; empty tables
give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._bytes import LOWER, PAD, SPACED, chunks, hash_spans, words
from ._spark import checkpointed, partitions
from .suffix_dedup import flow, pack, small, unpack

P_HOT, CODES, UPPER, PRIOR, GAIN = 5e-4, 62_500, 2, 2.5, 0.0
#: Words before a token that a context holds at most: the nearest two by identity, the third by a class of 8 bits.
DEPTH = 3
#: Codes of a word that is written out, and of the place before the first word.
WRITTEN, BEGIN = 0, 65535
FOLDS, FOLD = 7, 2
#: The end's place among token hashes (the hash of a blank, which no word is).
END = hash_spans(np.concatenate([np.array([32], np.uint8), np.zeros(PAD, np.uint8)]), np.array([0]), np.array([1]))[0]
_FLOW = "target long, kind int, payload binary"
RECORDS, WHOLE, SUMS = 0, 1, 2


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == FOLD, F.lit(False))


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, row_off): each row's words and its end."""
    low = LOWER[buf]
    starts, ends, word_off = words(low, off, SPACED)
    h = hash_spans(low, starts, ends - starts)
    row_off = word_off + np.arange(len(word_off))
    out = np.full(int(row_off[-1]), END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[row_off[1:] - 1] = False
    out[keep] = h
    return out, row_off


def word_counts(docs: DataFrame) -> DataFrame:
    """(token, n) over the rows of ``docs`` (doc_id, text): each task sums its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def joined() -> tuple[np.ndarray, np.ndarray]:
            t, n = (np.concatenate(x) for x in zip(*held, strict=True))
            token, which = np.unique(t, return_inverse=True)
            return token, np.bincount(which, weights=n, minlength=len(token)).astype(np.int64)

        for _, buf, off in chunks(batches, "text"):
            held.append(np.unique(tokens(buf, off)[0], return_counts=True))
            size += len(held[-1][0])
            if size > 2_000_000:
                held = [joined()]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield _counts(*held[0])
                    held, size = [], 0
        if held:
            yield _counts(*joined())

    return docs.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _counts(token: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])


@dataclass
class Alphabet:
    """Frequent words by hash, their counts, and the corpus's totals; symbol 0 is the class of all other words."""

    hashes: np.ndarray
    counts: np.ndarray
    total: int  # N
    distinct: int  # V

    @property
    def size(self) -> int:
        return len(self.hashes) + 1

    @property
    def rest(self) -> int:
        """Training tokens of the class."""
        return self.total - int(self.counts.sum())

    def symbols(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        slots = np.zeros(1 << 16, bool)
        slots[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
        out = np.zeros(len(h), np.int64)
        maybe = np.flatnonzero(slots[(h & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        good = self.hashes[at] == h[maybe]
        out[maybe[good]] = at[good] + 1
        return out


def alphabet(counts: DataFrame, p_min: float = P_HOT) -> Alphabet:
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total = int(totals["n"])
    # the end is always a symbol; at most 1 / p_min words have the share
    rows = counts.where((F.col("n") >= F.lit(p_min) * total) | (F.col("token") == int(END.view(np.int64)))).toArrow()
    h, n = np.asarray(rows.column("token"), dtype=np.int64).view(np.uint64), np.asarray(rows.column("n"), dtype=np.int64)
    order = np.argsort(h)
    return Alphabet(h[order], n[order], total, int(totals["v"]))


@dataclass
class Tree:
    """Retained contexts: state numbers by depth, and log10 next-symbol probabilities of each state."""

    size: int
    codes: list[np.ndarray]  # codes[d - 1]: sorted codes of the retained contexts of d symbols
    states: list[np.ndarray]  # their state numbers
    log10: np.ndarray  # (states, size); state 0 is the empty context

    def longest(self, symbol: np.ndarray, row_off: np.ndarray) -> np.ndarray:
        """The state before each token: its longest retained suffix."""
        state = np.zeros(len(symbol), np.int64)
        place = np.arange(len(symbol)) - np.repeat(row_off[:-1], np.diff(row_off))
        for d, (codes, states) in enumerate(zip(self.codes, self.states, strict=True), 1):
            if not len(codes):
                continue
            code = context_codes(symbol, d, self.size)
            at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            good = (codes[at] == code) & (place >= d)
            state[good] = states[at[good]]
        return state


def context_codes(symbol: np.ndarray, depth: int, size: int) -> np.ndarray:
    """For each position the code of the ``depth`` symbols before it, the nearest in the lowest digit (undefined near the start)."""
    code = np.zeros(len(symbol), np.int64)
    for k in range(depth):
        code[k + 1 :] += symbol[: -k - 1] * size**k
    return code


def context_counts(docs: DataFrame, shared, depth: int, parents: np.ndarray | None) -> DataFrame:
    """(context, symbol, n) of the contexts of ``depth`` symbols; only those whose nearer part is among ``parents``."""
    size = shared.value.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters: Alphabet = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for _, buf, off in chunks(batches, "text"):
            h, row_off = tokens(buf, off)
            symbol = letters.symbols(h)
            place = np.arange(len(symbol)) - np.repeat(row_off[:-1], np.diff(row_off))
            keep = place >= depth
            code = context_codes(symbol, depth, size)
            if parents is not None:
                keep &= np.isin(code, parents)
            held.append(np.unique(code[keep] * size + symbol[keep], return_counts=True))
            if len(held) >= 16:
                held = [_sum(held)]
        if held:
            code, n = _sum(held)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

    return docs.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _sum(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, n = (np.concatenate(x) for x in zip(*held, strict=True))
    distinct, which = np.unique(code, return_inverse=True)
    return distinct, np.bincount(which, weights=n, minlength=len(distinct)).astype(np.int64)


@dataclass
class Codes:
    """Numbers of the words of some share: sorted hashes, their numbers by rank of frequency (from 1), counts and upper-tree symbols by number."""

    hashes: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray  # by number; [0] is unused
    symbols: np.ndarray  # by number up to BEGIN; 0: not frequent
    written_tokens: int
    written_words: int

    def of(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, WRITTEN for words that have none."""
        out = np.zeros(len(h), np.uint16)
        if not len(self.hashes):
            return out
        slots = np.zeros(1 << 20, bool)
        slots[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        maybe = np.flatnonzero(slots[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
        good = self.hashes[at] == h[maybe]
        out[maybe[good]] = self.numbers[at[good]]
        return out


def codes(counts: DataFrame, letters: Alphabet, most: int = CODES) -> Codes:
    """At most ``most`` words have a share of 1 / ``most`` of the tokens (and the end has a number always)."""
    rows = counts.where((F.col("n") * most >= max(letters.total, 1)) | (F.col("token") == int(END.view(np.int64)))).toArrow()
    h, n = np.asarray(rows.column("token"), dtype=np.int64).view(np.uint64), np.asarray(rows.column("n"), dtype=np.int64)
    rank = np.lexsort((h, -n))
    number = np.empty(len(h), np.int64)
    number[rank] = np.arange(1, len(h) + 1)
    order = np.argsort(h)
    by_number = np.zeros(len(h) + 1, np.int64)
    by_number[number] = n
    symbols = np.zeros(BEGIN + 1, np.int64)
    symbols[number] = letters.symbols(h)
    return Codes(h[order], number[order].astype(np.uint16), by_number, symbols, letters.total - int(n.sum()), letters.distinct - int((n > 0).sum()))


def grow(train: DataFrame, letters: Alphabet, p_min: float = P_HOT, depth: int = UPPER, prior: float = PRIOR, gain: float = GAIN) -> tuple[Tree, np.ndarray]:
    """(the upper tree, codes of the pairs of frequent words that have the share), one pass over the training texts a depth."""
    size = letters.size
    base = np.concatenate([[letters.rest], letters.counts]).astype(np.float64) + 1.0
    rows = [base / base.sum()]
    found, states = [], []
    parent_states = {0: 0}
    shared = train.sparkSession.sparkContext.broadcast(letters)
    pairs = np.zeros(0, np.int64)
    wanted: np.ndarray | None = None
    for d in range(1, depth + 1):
        counts = checkpointed(context_counts(train, shared, d, wanted))
        # contexts of a p_min share at least: 1 / p_min of them, each with as many symbols at most
        big = counts.withColumn("context", F.floor(F.col("code") / size)).groupBy("context").agg(F.sum("n").alias("total")).where(F.col("total") >= p_min * max(letters.total, 1))
        table = counts.withColumn("context", F.floor(F.col("code") / size)).join(F.broadcast(big), "context").select("code", "n").toArrow()
        code, n = np.asarray(table.column("code"), dtype=np.int64), np.asarray(table.column("n"), dtype=np.float64)
        context, symbol = code // size, code % size
        kept_codes, kept_states, here = [], [], {}
        order = np.argsort(context, kind="stable")
        cut = np.flatnonzero(np.concatenate([[True], np.diff(context[order]) != 0, [True]])) if len(order) else np.zeros(1, np.int64)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            at = order[a:b]
            c = int(context[at[0]])
            up = rows[parent_states.get(c % size ** (d - 1), 0)]
            total, kinds = n[at].sum(), prior * len(at)
            p = kinds * up
            p[symbol[at]] += n[at]
            p /= total + kinds
            seen = n[at] / total
            if total * float((seen * np.log2(seen / up[symbol[at]])).sum()) >= gain * total + math.log2(max(letters.total, 2)):
                kept_codes.append(c)
                kept_states.append(len(rows))
                here[c] = len(rows)
                rows.append(p)
        found.append(np.array(kept_codes, np.int64))
        states.append(np.array(kept_states, np.int64))
        if d == 1:
            often = (n >= p_min * max(letters.total, 1)) & (context > 0) & (symbol > 0)
            pairs = np.sort(code[often])
            # a longer context is counted where it can have the share itself; its nearer part need not be retained
            wanted = np.sort(code[n >= p_min * max(letters.total, 1)])
            parent_states = here
        if not len(wanted):
            break
    order = [np.argsort(x) for x in found]
    return Tree(size, [x[o] for x, o in zip(found, order, strict=True)], [x[o] for x, o in zip(states, order, strict=True)], np.log10(np.stack(rows)).astype(np.float32)), pairs


# --- records ---------------------------------------------------------------------------------------


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xC2B2AE3D27D4EB4F))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _bin(key: np.ndarray, bins: int) -> np.ndarray:
    return ((key >> np.uint64(40)) % np.uint64(bins)).astype(np.int64)


def squeezed(*arrays: np.ndarray) -> bytes:
    body = pack(*arrays)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def opened(payload: bytes, count: int) -> list[np.ndarray]:
    body = pa.decompress(payload[8:], int.from_bytes(payload[:8], "little"), codec="zstd", asbytes=True)
    return unpack(body, count)[0]


def start_level(s1: np.ndarray, s2: np.ndarray, begins: np.ndarray, pairs: np.ndarray, size: int) -> np.ndarray:
    """The least number of words by which a record is dealt: 1, 2 behind a frequent word, 3 behind a frequent pair."""
    out = np.where(s1 > 0, 2, 1)
    if len(pairs):
        code = s2 * size + s1
        at = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
        out[(pairs[at] == code) & (s1 > 0) & (s2 > 0) & ~begins] = 3
    return out


def _record_pass(model, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, tree, pairs = model.value
        logs = np.concatenate([[0.0], np.log10(known.counts[1:] + 1.0)])
        task = TaskContext.get().partitionId()
        for part, (rows, buf, off) in enumerate(chunks(batches, "text", 8 << 20)):
            h, row_off = tokens(buf, off)
            n, size = rows.num_rows, np.diff(row_off)
            code = known.of(h)
            row = np.repeat(np.arange(n), size)
            place = np.arange(len(h)) - row_off[row]
            held = np.asarray(rows.column("held")).astype(np.int64)
            written = code == WRITTEN
            low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            # a row's first token has no word before it: it is scored from the root at once
            first = row_off[:-1]
            total = known_log(known, tree, np.zeros(n, np.int64), code[first])
            base = np.bincount(row, weights=logs[code], minlength=n)
            sure = size - np.bincount(row[written], minlength=n)
            batch = (task << 24) | part  # the same on every attempt: it names the rows by input split and place
            whole = pack(np.asarray(rows.column("doc_id").fill_null(0)), np.asarray(rows.column("doc_id").is_null()).astype(np.int64), held, size, sure.astype(np.int64), total.view(np.int64), base.view(np.int64))
            out = [(batch % bins, WHOLE, batch.to_bytes(8, "little") + whole)]
            i = np.flatnonzero(place > 0)
            if len(i):
                two = place[i] > 1
                c2 = np.where(two, code[i - 1 - two], BEGIN).astype(np.uint16)
                h2 = np.where(two, h[i - 1 - two], np.uint64(7))
                three = place[i] > 2
                h3 = np.where(three, h[i - 1 - two - three], np.uint64(11))
                s1 = known.symbols[code[i - 1]]
                level = start_level(s1, known.symbols[c2], ~two, pairs, tree.size)
                third = (h3 >> np.uint64(56)).astype(np.uint8)
                key = h[i - 1].copy()
                deeper = level > 1
                key[deeper] = _mix(key[deeper], h2[deeper])
                deepest = level > 2
                key[deepest] = _mix(key[deepest], third[deepest].astype(np.uint64))
                target = _bin(key, bins)
                order = np.argsort(target, kind="stable")
                bounds = np.searchsorted(target[order], np.arange(bins + 1))
                for b in np.flatnonzero(np.diff(bounds)).tolist():
                    at = order[bounds[b] : bounds[b + 1]]
                    j = i[at]
                    one, nxt, second = code[j - 1], code[j], c2[at]
                    flag = np.packbits(held[row[j]].astype(bool))
                    out.append((b, RECORDS, batch.to_bytes(8, "little") + squeezed(
                        one, low[j - 1][one == WRITTEN], second, (h2[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32)[second == WRITTEN], np.frombuffer(third[at].tobytes() + bytes(-len(at) % 2), "<u2"), nxt, low[j][nxt == WRITTEN], small(np.diff(row[j], prepend=0)), np.frombuffer(flag.tobytes() + bytes(-len(flag) % 2), "<u2")
                    )))
            for at in range(0, len(out), 256):
                yield flow(out[at : at + 256])

    return run


def known_log(known: Codes, tree: Tree, state: np.ndarray, code: np.ndarray) -> np.ndarray:
    """log10 of tokens by the upper tree: its symbol, and within the class of other words their share of it."""
    symbol = known.symbols[code]
    out = tree.log10[state, symbol].astype(np.float64)
    other = np.flatnonzero(symbol == 0)
    frequent = known.symbols[np.arange(1, len(known.counts))] > 0
    rest = float((known.counts[1:][~frequent] + 1).sum() + known.written_tokens + known.written_words + 1)
    share = np.concatenate([[(known.written_tokens + known.written_words + 1.0) / (known.written_words + 1.0)], known.counts[1:] + 1.0]) / rest
    out[other] += np.log10(share)[code[other]]
    return out


def _filled(code: np.ndarray, written: np.ndarray) -> np.ndarray:
    """One number a word: its code, or its hash beyond all codes."""
    out = code.astype(np.uint64)
    out[code == WRITTEN] = written.astype(np.uint64) | np.uint64(1 << 40)
    return out


def scored(known: Codes, tree: Tree, pairs: np.ndarray, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, nxt: np.ndarray, train: np.ndarray, total: int, prior: float, gain: float) -> np.ndarray:
    """log10 probabilities of records that hold all of their contexts; ``train`` marks those that are counted."""
    code = lambda w: np.where(w <= BEGIN, w, WRITTEN).astype(np.int64)
    s1, begins = known.symbols[code(w1)], w2 == BEGIN
    s2 = np.where(begins, 0, known.symbols[code(w2)])
    level = start_level(s1, s2, begins, pairs, tree.size)
    state = np.zeros(len(w1), np.int64)
    for d, (found, states) in enumerate(zip(tree.codes, tree.states, strict=True), 1):
        if len(found):
            c = s1 if d == 1 else s2 * tree.size + s1
            at = np.minimum(np.searchsorted(found, c), len(found) - 1)
            good = (found[at] == c) & ((d == 1) | (~begins & (level >= 2)))
            state[good] = states[at[good]]
    p = 10.0 ** known_log(known, tree, state, code(nxt))
    context = np.zeros(len(w1), np.uint64)
    bar = math.log2(max(total, 2))
    for d, w in enumerate((w1, w2, w3), 1):
        context = _mix(context, w)
        at = np.flatnonzero((level <= d) & ((d < 3) | ~begins))
        if not len(at):
            continue
        at = at[np.lexsort((nxt[at], context[at]))]
        new_context = np.ones(len(at), bool)
        new_context[1:] = context[at[1:]] != context[at[:-1]]
        new_pair = new_context.copy()
        new_pair[1:] |= nxt[at[1:]] != nxt[at[:-1]]
        pair = np.cumsum(new_pair) - 1
        head = at[new_pair]
        n = np.bincount(pair, weights=train[at])
        of = np.cumsum(new_context)[new_pair] - 1
        n_context = np.bincount(of, weights=n)
        kinds = prior * np.bincount(of, weights=n > 0)
        seen = n > 0
        gained = np.zeros(len(n))
        gained[seen] = n[seen] * np.log2(n[seen] / n_context[of[seen]] / p[head[seen]])
        keep = (n_context > 0) & (np.bincount(of, weights=gained) >= gain * n_context + bar)
        mine = keep[of[pair]]
        i, k = at[mine], pair[mine]
        p[i] = (n[k] + kinds[of[k]] * p[i]) / (n_context[of[k]] + kinds[of[k]])
    return np.log10(p)


def _bin_pass(model, total: int, prior: float, gain: float):
    def run(table: pa.Table) -> pa.Table:
        known, tree, pairs = model.value
        kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
        out = [(int.from_bytes(p[:8], "little"), WHOLE, p[8:]) for k, p in zip(kinds, payloads, strict=True) if k == WHOLE]
        # in order of their bytes, so that a repeated run adds the same numbers in the same order
        mine = sorted(p for k, p in zip(kinds, payloads, strict=True) if k == RECORDS)
        del table, payloads
        parts, rows, batches = [], [], []
        for p in mine:
            c1, h1, c2, h2, third, cn, hn, step, flag = opened(p[8:], 9)
            n = len(c1)
            train = ~np.unpackbits(np.frombuffer(flag.tobytes(), np.uint8))[:n].astype(bool)
            parts.append((_filled(c1, h1), _filled(c2, h2), np.frombuffer(third.tobytes(), np.uint8)[:n].astype(np.uint64), _filled(cn, hn), train))
            rows.append(np.cumsum(step.astype(np.int64)))
            batches.append(int.from_bytes(p[:8], "little"))
        del mine
        if parts:
            w1, w2, w3, nxt, train = (np.concatenate(x) for x in zip(*parts, strict=True))
            sizes = [len(x[0]) for x in parts]
            del parts
            score = scored(known, tree, pairs, w1, w2, w3, nxt, train, total, prior, gain)
            # a written word is the nearest one of exactly one record each time it stands in a text: its count and its part of the base
            written = np.flatnonzero(w1 > BEGIN)
            base, sure = np.zeros(len(w1)), np.zeros(len(w1), bool)
            if len(written):
                _, which = np.unique(w1[written], return_inverse=True)
                count = np.bincount(which, weights=train[written])[which]
                base[written], sure[written] = np.log10(count + 1.0), count > 0
            at = 0
            for batch, row, n in zip(batches, rows, sizes, strict=True):
                distinct, which = np.unique(row, return_inverse=True)
                sums = [np.bincount(which, weights=x[at : at + n], minlength=len(distinct)) for x in (score, base, sure)]
                out.append((batch, SUMS, squeezed(small(np.diff(distinct, prepend=0)), sums[0].astype("<f4").view("<u4"), sums[1].view(np.int64), small(sums[2].astype(np.int64)))))
                at += n
        return pa.Table.from_batches([flow(out)])

    return run


def _total(letters: Alphabet):
    n, v = letters.total, letters.distinct

    def run(table: pa.Table) -> pa.Table:
        kinds, payloads = table.column("kind").to_pylist(), table.column("payload").to_pylist()
        whole = next(p for k, p in zip(kinds, payloads, strict=True) if k == WHOLE)
        (ident, null, held, size, sure, total, base), _ = unpack(whole, 7)
        total, base, sure = total.view(np.float64).copy(), base.view(np.float64).copy(), sure.copy()
        for p in sorted(p for k, p in zip(kinds, payloads, strict=True) if k == SUMS):
            step, score, part, known = opened(p, 4)
            rows = np.cumsum(step.astype(np.int64))
            total[rows] += score.view("<f4")
            base[rows] += part.view(np.float64)
            sure[rows] += known
        return pa.table(
            [pa.array(ident, mask=null.astype(bool)), pa.array(held.astype(bool)), pa.array(size), pa.array(sure), pa.array(np.full(len(size), n)), pa.array(base - size * math.log10(n + v + 1)), pa.array(total)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return run


def language_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", p_hot: float = P_HOT, prior: float = PRIOR, gain: float = GAIN, numbered: int = CODES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of ``docs``."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("held", held_out())
    train = source.where(~F.col("held")).select("doc_id", "text")
    counts = checkpointed(word_counts(train))
    letters = alphabet(counts, p_hot)
    tree, pairs = grow(train, letters, p_hot, UPPER, prior, gain)
    bins = 2 * partitions(spark)
    model = spark.sparkContext.broadcast((codes(counts, letters, numbered), tree, pairs))
    dealt = source.mapInArrow(_record_pass(model, bins), _FLOW).groupBy("target")
    sums = dealt.applyInArrow(_bin_pass(model, letters.total, prior, gain), _FLOW)
    return sums.groupBy("target").applyInArrow(_total(letters), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
