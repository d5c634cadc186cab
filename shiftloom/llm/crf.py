"""A linear-chain conditional random field over word shapes: features from bytes, training, and exact Viterbi in numpy batches.

A word's features (shape, cue, digits, length, hexadecimal, quotes) are those of its signature, which numpy computes for
all words of a chunk; only signatures not met before are spelt out one by one. A word's emission is a sum over itself and two
neighbours on either side.

Decoding goes over whole texts. An entity has at most ``MOST_WORDS`` words. For every word and kind the most that an entity which begins there can gain
over outside labels is bounded (its emissions and the greatest transitions, the best end found by shifted running sums); where no bound is above zero, no
best path has an entity that begins there. The words that some possible entity covers go through Viterbi between their outside neighbours, runs of
like length together.
"""

from __future__ import annotations

import re
import zlib

import numpy as np

from ._bytes import LOWER, PAD, byte_class, hash_spans, ranges

KINDS = ("email", "phone", "id", "secret", "person", "birth")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
FEATURES = 1 << 14
#: Words whose identity is a feature (fixed values).
CUES = (
    "at", "dot", "(at)", "(dot)", "[at]", "[dot]", "com", "org", "net", "call", "phone", "tel", "mobile", "fax", "cell", "ssn", "id", "iban", "passport", "account", "licence", "number", "no", "token", "key", "api_key", "apikey", "password", "passwd", "pwd", "secret", "bearer", "=", ":", "is", "mail", "email", "e-mail",
    "contact", "write", "reach", "me", "mr", "mrs", "ms", "dr", "prof", "name", "patient", "named", "born", "birth", "dob", "on", "of", "the", "and", "or", "in", "version", "page", "total", "date", "license",
)
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = ord("X"), ord("x"), ord("9"), ord("u")
_LETTER = byte_class(lambda b: b in b"Xxu")
_HEX = byte_class(lambda b: chr(b) in "0123456789abcdefABCDEF")
_TAIL = byte_class(lambda b: b in b".,;:!?")
_QUOTE = byte_class(lambda b: b in b"\"'([{<")
_CLOSE = byte_class(lambda b: b in b"\"')]}>.,;:!?")
EDGE = "edge"


def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def _pad(data: bytes) -> np.ndarray:
    return np.frombuffer(data + bytes(PAD), np.uint8)


_CUE_KEYS = np.array([int(hash_spans(_pad(c.encode()), np.array([0]), np.array([len(c.encode())]))[0]) for c in CUES], np.uint64)
_CUE_ORDER = np.argsort(_CUE_KEYS)


class Signatures:
    """Words told apart by what their features can see: an index for each word, and the features of each index."""

    def __init__(self):
        self.known: dict[int, int] = {}
        self.names: list[list[str]] = []

    def of(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The index of each word (a byte span of the padded buffer)."""
        if not len(starts):
            return np.zeros(0, np.int64)
        whole = hash_spans(buf, starts, ends - starts)
        distinct, first, which = np.unique(whole, return_index=True, return_inverse=True)
        s, n = starts[first], (ends - starts)[first]
        off = np.concatenate([[0], np.cumsum(n)])
        data = buf[ranges(s, n)]
        cls = _CLASS[data]
        begins = np.zeros(len(data), bool)
        begins[off[:-1]] = True
        same = np.zeros(len(data), bool)
        same[1:] = (cls[1:] == cls[:-1]) & ~begins[1:]
        run = np.arange(len(data)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(data))))
        keep = ~(same & (_LETTER[cls] == 1)) & ~((cls == ord("9")) & (run > 4))
        kept = np.concatenate([[0], np.cumsum(keep)])
        shape = np.concatenate([cls[keep], np.zeros(PAD, np.uint8)])
        h = hash_spans(shape, kept[off[:-1]], kept[off[1:]] - kept[off[:-1]], 3)
        digits = np.add.reduceat((cls == ord("9")).astype(np.int64), off[:-1])
        hexa = np.add.reduceat(_HEX[data].astype(np.int64), off[:-1])
        tail = n.copy()
        for _ in range(3):
            tail -= (tail > 1) & (_TAIL[buf[s + np.maximum(tail, 1) - 1]] == 1)
        low = hash_spans(LOWER[buf], s, tail)
        at = np.minimum(np.searchsorted(_CUE_KEYS[_CUE_ORDER], low), len(CUES) - 1)
        cue = np.where(_CUE_KEYS[_CUE_ORDER][at] == low, _CUE_ORDER[at] + 1, 0)
        parts = (cue, np.minimum(digits, 12), np.minimum(n // 4, 9), (n >= 20) & (10 * hexa >= 9 * n), _QUOTE[buf[s]], _CLOSE[buf[s + n - 1]])
        key = h
        for p in parts:
            key = (key ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        signs, one, of = np.unique(key, return_index=True, return_inverse=True)
        index = np.empty(len(signs), np.int64)
        for k, (sign, i) in enumerate(zip(signs.tolist(), one.tolist(), strict=True)):
            got = self.known.get(sign)
            if got is None:
                got = self.known[sign] = len(self.names)
                form = shape[kept[off[i]] : kept[off[i + 1]]].tobytes().decode("latin-1")
                c, d, size, is_hex, opened, closed = (int(p[i]) for p in parts)
                self.names.append([f"s={form}", f"w={CUES[c - 1] if c else '-'}", f"n={d}", f"l={size}", f"h={is_hex}", f"q={opened}{closed}", f"sl={form}|{size}", f"nl={d}|{size}|{form[:1]}"])
            index[k] = got
        return index[of][which]


#: How far features of neighbours reach and which of them count: (distance, number of features).
ROLES = ((0, 8), (-1, 3), (1, 3), (-2, 2), (2, 2))


def role_ids(names: list[str], distance: int, count: int) -> list[int]:
    return [_feature(f"{distance}{x}") for x in names[:count]]


def _padded(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = np.arange(int(lengths.max(initial=0)))
    return t, t[None, :] < lengths[:, None]


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Emitter:
    """Emissions of words by their signatures: a table a role, grown as signatures are met; row 0 stands for what lies outside a text."""

    def __init__(self, emission: np.ndarray):
        self.emission = emission
        self.signatures = Signatures()
        self.tables = [np.asarray(emission[_feature(f"{d}{EDGE}")] if d else np.zeros(emission.shape[1]), np.float32)[None] for d, _ in ROLES]

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(words, labels) of sequences that lie end to end, bounded by ``off``."""
        index = self.signatures.of(buf, starts, ends) + 1
        new = self.signatures.names[len(self.tables[0]) - 1 :]
        if new:
            for k, (distance, count) in enumerate(ROLES):
                self.tables[k] = np.concatenate([self.tables[k], np.stack([self.emission[role_ids(x, distance, count)].sum(axis=0) for x in new])])
        # two places of nothing on either side of each text
        spot = np.arange(len(index)) + 2 * np.repeat(np.arange(1, len(off)), np.diff(off))
        wide = np.zeros(len(index) + 2 * len(off), np.int64)
        wide[spot] = index
        out = self.tables[0][index]
        for table, (distance, _) in zip(self.tables[1:], ROLES[1:], strict=True):
            out += table[wide[spot + distance]]
        return out


#: No labelled entity has more words.
MOST_WORDS = 8


class LinearChainCRF:
    def __init__(self, emission: np.ndarray, transition: np.ndarray):
        self.emission, self.transition = emission, transition

    @staticmethod
    def allowed() -> np.ndarray:
        """An inside label follows the begin or inside label of its kind only."""
        ok = np.zeros((len(LABELS), len(LABELS)))
        for j, to in enumerate(LABELS):
            for i, came in enumerate(LABELS):
                if to[0] == "I" and came[2:] != to[2:]:
                    ok[i, j] = -1e4
        return ok

    @staticmethod
    def start() -> np.ndarray:
        return np.array([-1e4 if x[0] == "I" else 0.0 for x in LABELS])

    @classmethod
    def fit(cls, sentences: list[tuple[list[str], list[str]]], steps: int = 70, rate: float = 0.2, l2: float = 1e-3) -> LinearChainCRF:
        """Maximum likelihood with an L2 penalty: full-batch Adam on forward-backward gradients."""
        k, signs = len(LABELS), Signatures()
        lengths = np.array([len(t) for t, _ in sentences])
        t, mask = _padded(lengths)
        index = []
        for tokens, _ in sentences:
            data = [x.encode() for x in tokens]
            ends = np.cumsum([len(x) for x in data])
            index.append(signs.of(_pad(b"".join(data)), ends - [len(x) for x in data], ends))
        width = sum(c for _, c in ROLES)
        x = np.zeros((len(sentences), len(t), width), np.int32)
        y = np.zeros((len(sentences), len(t)), np.int64)
        for i, (tokens, labels) in enumerate(sentences):
            names = [signs.names[j] for j in index[i]]
            for j in range(len(tokens)):
                ids = [f for d, c in ROLES for f in (role_ids(names[j + d], d, c) if 0 <= j + d < len(names) else [_feature(f"{d}{EDGE}")])]
                x[i, j, : len(ids)] = ids
                x[i, j, len(ids) :] = FEATURES  # a row that stays zero
            y[i, : len(tokens)] = [LABELS.index(a) for a in labels]
        rule, begin = cls.allowed(), cls.start()
        used, slot = np.unique(x[mask], return_inverse=True)
        flat = np.zeros(x.shape, np.int32)
        flat[mask] = slot.reshape(-1, width)
        params = [np.zeros((len(used), k)), np.zeros((k, k))]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        rows, total = np.arange(len(sentences)), len(sentences)
        for step in range(1, steps + 1):
            e = params[0][flat].sum(axis=2)
            move = params[1] + rule
            alpha, beta = np.zeros_like(e), np.zeros_like(e)
            alpha[:, 0] = e[:, 0] + begin
            for i in range(1, len(t)):
                new = log_sum(alpha[:, i - 1, :, None] + move[None], 1) + e[:, i]
                alpha[:, i] = np.where(mask[:, i, None], new, alpha[:, i - 1])
            for i in range(len(t) - 2, -1, -1):
                new = log_sum(move[None] + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
                beta[:, i] = np.where(mask[:, i + 1, None], new, 0.0)
            z = log_sum(alpha[rows, lengths - 1], 1)
            p = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
            p[rows[:, None], np.arange(len(t))[None, :], y] -= mask
            g0 = l2 * params[0] * total
            each, ids = np.repeat(p[mask], width, axis=0), flat[mask].ravel()
            for c in range(k):
                g0[:, c] += np.bincount(ids, weights=each[:, c], minlength=len(used))
            g1 = l2 * params[1] * total
            for i in range(1, len(t)):
                both = np.exp(alpha[:, i - 1, :, None] + move[None] + (e[:, i] + beta[:, i])[:, None, :] - z[:, None, None]) * mask[:, i, None, None]
                g1 += both.sum(axis=0)
                np.subtract.at(g1, (y[mask[:, i], i - 1], y[mask[:, i], i]), 1.0)
            g0[used == FEATURES] = 0.0
            for n, g in enumerate((g0 / total, g1 / total)):
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.99 * second[n] + 0.01 * g * g
                params[n] -= rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)
        emission = np.zeros((FEATURES, k), np.float32)
        real = used < FEATURES
        emission[used[real]] = params[0][real]
        return cls(emission, (params[1] + rule).astype(np.float32))

    def possible(self, e: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Words that an entity of some best path may cover."""
        t, n = self.transition.astype(np.float64), len(e)
        free = [j for j, x in enumerate(LABELS) if x[0] != "I"]  # what can follow anything
        left = np.repeat(off[1:], np.diff(off)) - np.arange(n)  # words to the text's end
        covered = np.zeros(n + 1, np.int32)
        for b in range(1, len(LABELS), 2):
            i = b + 1
            enter = max((t[:, b] - t[:, 0]).max(), 0.0)
            leave = max((t[np.ix_([b, i], free)] - t[0, free][None]).max(), 0.0)
            begin = (e[:, b] - e[:, 0]).astype(np.float64) + enter + leave
            step = (e[:, i] - e[:, 0]).astype(np.float64) + max(t[b, i], t[i, i]) - t[0, 0]
            best, total, reach = np.zeros(n), np.zeros(n), np.ones(n, np.int64)
            for d in range(1, MOST_WORDS):
                total[:-d] += step[d:]
                better = (left > d) & (total + begin > 0)
                reach[better] = d + 1
                best = np.where(left > d, np.maximum(best, total), best)
            at = np.flatnonzero(begin + best > -1e-6)
            covered[at] += 1
            np.subtract.at(covered, at + reach[at], 1)
        return np.cumsum(covered)[:n] > 0

    def decode(self, e: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The best labels of sequences that lie end to end in ``e``; entities have at most MOST_WORDS words."""
        out = np.zeros(len(e), np.int8)
        open_words = np.flatnonzero(self.possible(e, off)) if len(e) else np.zeros(0, np.int64)
        if not len(open_words):
            return out
        row = np.searchsorted(off, open_words, "right") - 1
        fresh = np.concatenate([[True], (np.diff(open_words) > 1) | (np.diff(row) > 0)])
        first = np.flatnonzero(fresh)
        lengths = np.diff(np.concatenate([first, [len(open_words)]]))
        begin = open_words[first]
        self._viterbi(e, begin, lengths, begin > off[row[first]], begin + lengths < off[row[first] + 1], out)
        return out

    def _viterbi(self, e: np.ndarray, begin: np.ndarray, lengths: np.ndarray, after_o: np.ndarray, before_o: np.ndarray, out: np.ndarray, cells: int = 200_000) -> None:
        """Labels of runs; ``after_o`` and ``before_o``: whether an outside word stands before and behind."""
        order = np.argsort(lengths, kind="stable")
        first = [self.start().astype(np.float32), self.transition[0]]
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and (to - at + 1) * lengths[order[to]] <= cells:
                to += 1
            group = order[at:to]
            at = to
            n = lengths[group]
            t, mask = _padded(n)
            place = np.where(mask, begin[group][:, None] + t[None, :], begin[group][:, None])
            score = e[place[:, 0]] + np.where(after_o[group][:, None], first[1][None], first[0][None])
            back = np.zeros((len(group), len(t), len(LABELS)), np.int8)
            for i in range(1, len(t)):
                paths = score[:, :, None] + self.transition[None]
                best = paths.argmax(axis=1)
                back[:, i] = best
                new = np.take_along_axis(paths, best[:, None, :], 1)[:, 0] + e[place[:, i]]
                score = np.where(mask[:, i, None], new, score)
            label = (score + np.where(before_o[group][:, None], self.transition[:, 0][None], 0.0)).argmax(axis=1)
            for i in range(len(t) - 1, -1, -1):
                live = mask[:, i]
                out[place[live, i]] = label[live]
                if i:
                    label = np.where(live, back[np.arange(len(group)), i, label], label)


# --- the labelled table ----------------------------------------------------------------------------

#: Forms of each kind: # a digit, ? a capital, % a letter or digit, ~ 32 to 40 hexadecimal digits, @w a made-up word, @W one with a capital.
FORMS = {
    "email": ("@w at @w dot com", "@w (at) @w (dot) org", "@w dot @w at @w dot com", "@w [at] @w [dot] net", "@w.@w at @w dot org", "@w## (at) @w (dot) com", "@w at @w dot @w dot org", "@w_@w [at] @w [dot] com"),
    "phone": ("(###) ###-####", "###-###-####", "### ### ####", "0## ########", "###.###.####", "(0##) #######", "1-###-###-####", "0### ### ###"),
    "id": ("###-##-####", "X########", "??## #### #### #### ####", "??##################", "##-#######", "?######?", "???######", "### ## ####"),
    "secret": ('"~"', "~", "@w##@w##", "AKIA????????????????", "%%%%%%%%-%%%%-%%%%%%%%", "@W##!@w#", "gh_%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%", '"%%%%%%%%%%%%%%%%%%%%%%%%"', "sk-%%%%%%%%%%%%%%%%%%%%%%%%"),
    "person": ("@W @W", "@W ?. @W", "@W @W-@W", "@W @W @W"),
    "birth": ("##/##/####", "##.##.####", "####-##-##", "## @W ####"),
}
#: Where forms stand. Every third one is held out.
PLACES = {
    "email": ("write to {} for more", "contact {} now", "@w @w {} @w", "mail me : {} please", "email {}", "reach @w {} or @w", "e-mail : {} @w @w"),
    "phone": ("call {} after @w", "phone {} or @w", "@w @w call {} @w", "tel : {} @w", "mobile {}", "fax {} @w @w", "my cell is {} , @w"),
    "id": ("ssn {} @w", "passport no {} @w", "@w @w ssn : {} @w", "id number {}", "account {} @w @w", "iban : {} @w", "licence {} of @w"),
    "secret": ("token = {} @w", "password : {} now", "@w @w token = {}", "api_key = {}", "secret key = {} @w", "pwd : {} @w @w", "the password is {} , @w", "bearer {} @w", "key : {} @w @w"),
    "person": ("mr. {} @w", "dr. {} @w @w", "name : {} , @w", "patient {} was @w", "mrs. {} and @w", "named {} @w"),
    "birth": ("born {} in @w", "born on {} , @w", "birth : {} @w", "dob {} @w", "date of birth {} @w"),
}
#: Sentences without personal data that look like some. Every fourth one is held out.
PLAIN = (
    "@w in #### the @w", "@w about ##,### of @w", "page ## of ###", "version #.#.# of @w", "it was ##.## or ##-## @w", "@w at the @w dot @w", "@w | @w | ################ | @w", "the @w @w @w.", "@w @w ########## @w @w", "@w, @w ## @w ### @w", "@w @w ########-#### @w", "@w call the @w at @w", "@w = ## @w", '@w "@w @w" @w',
    "token of @w and key of @w", "@w ###### ##### @w", "@w ##% of @w $## @w", "####-##-## @w", "##:## @w @w", "@w id @w ### @w", "(##) @w @w", "@w@w ## a # b", "public license, version #.", "@w ###, ### and ### @w", "@w.##@mail#.example.com @w @w", "@w +# (###) ###-#### ###.##.##.### @w @w", "@w ###.##.###.## @w @w", "@w ################ @w @w", "@W @w. @W @w @w", "@W @W. @W @W @W.",
    "the key @w is the @w", "name of the @w, @w and @w", "@w is @w, born of @w", "password of @w and @w", "write to the @w", "@w total : ## @w", "@w @w @w @w @w @w @w", "@W, @w! @w? @W...", "@w the secret of @w", "@W @w @W & @w", "@w ## @W ####", "##/## of @w", "@w (@w) [@w]", "@w : @w", "@w = @w", "the phone of @w @w", "mail @w, @w at home", "@w # @w", "@w{@w:#}", "https://@w.example.org/@w/## @w",
)


def labelled_table(held_out: bool = False, copies: int = 2, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """The small labelled table: (words, labels) of made-up sentences, by a rule from forms and places.

    Held-out sentences have places and made-up words that no training sentence has; forms are filled anew.
    """
    rng = np.random.default_rng(seed + held_out)
    parts = ("an", "ter", "lo", "mi", "est", "ra", "von", "que", "thi", "do", "sel", "ur") if not held_out else ("ka", "bri", "sto", "ein", "un", "lez", "ow", "mar", "pi", "hu")
    digits, letters = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = lambda: "".join(rng.choice(parts, rng.integers(1, 4)))
    rules = (("@w", word), ("@W", lambda: word().capitalize()), ("~", lambda: "".join(rng.choice(list("0123456789abcdef"), int(rng.integers(32, 41))))), ("#", lambda: str(rng.integers(0, 10))), (r"\?(?=[A-Z0-9? .]|$)", lambda: str(rng.choice(list(letters)))), ("%", lambda: str(rng.choice(list(digits + letters + letters.lower())))))

    def fill(text: str) -> str:
        for sign, make in rules:
            text = re.sub(sign, lambda _, make=make: make(), text)
        return text

    def shouted(tokens: list[str]) -> list[str]:
        return [t.upper() + ("!!" if rng.random() < 0.3 else "") for t in tokens]

    def mine(items: tuple, every: int) -> list:
        return [x for i, x in enumerate(items) if (i % every == every - 1) == held_out]

    out: list[tuple[list[str], list[str]]] = []
    for _ in range(copies):
        for kind in KINDS:
            for form in FORMS[kind]:
                for place in mine(PLACES[kind], 3):
                    left, right = place.split("{}")
                    words = [fill(f"{word()} " * int(rng.integers(0, 5)) + left).split(), fill(form).split(), fill(right + f" {word()}" * int(rng.integers(0, 5))).split()]
                    tokens = [t for w in words for t in w]
                    out.append((tokens if rng.random() > 0.06 or kind in ("secret", "person") else shouted(tokens), ["O"] * len(words[0]) + [("I-" if i else "B-") + kind for i in range(len(words[1]))] + ["O"] * len(words[2])))
        for plain in mine(PLAIN, 4) * 5:
            tokens = fill(f"{word()} " * int(rng.integers(0, 4)) + plain).split()
            out.append((tokens if rng.random() > 0.1 else shouted(tokens), ["O"] * len(tokens)))
        for i in range(40 if not held_out else 8):  # words repeated over and over, and words with capitals side by side
            one = fill("@W" if i % 2 else "@w") + ("." if i % 5 == 0 else "")
            many = [one] * int(rng.integers(5, 16)) if i % 4 else [fill("@W") for _ in range(8)]
            out.append((fill("@w @W @w").split() + many + fill("@w, @W").split(), ["O"] * (5 + len(many))))
        if not held_out:  # running prose
            out += [([(word().capitalize() if rng.random() < 0.2 else word()) + str(rng.choice(["", "", "", ".", ",", "."])) for _ in range(14)], ["O"] * 14) for _ in range(120)]
    return out
