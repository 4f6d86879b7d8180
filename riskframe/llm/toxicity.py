"""Toxicity: a support vector machine on a gap-weighted subsequence kernel with Nyström landmarks.

**Units.** Sentences are cut into units: a word in lower case without the signs in it (``i.d.i.o.t`` is ``idiot``), look-alike
digits as letters, between marks for its start and end; three or more one-letter words in a row are one unit. Longer words
are read in overlapping stretches. Every run of neighbouring words of a sentence, up to a stretch long, is a unit too, with
its blanks dropped: ``st up id`` is ``stupid``, and words that are harmless one by one have features together. A sentence
ends at a line's end and at a word that ends in ``.``, ``!`` or ``?``.

**Kernel.** A unit's features are its subsequences of three characters, each weighted by ``DECAY`` to the power of the
stretch that it spans (``REACH`` places at most) and scaled to the unit's length. So an inserted character or a gap only
lowers the weight of the subsequences that run across it.

**Landmarks.** Nyström features of a unit x are K(x, L) K(L, L)^(-1/2) over a set L of landmark units from the training
sentences. The machine is linear in them, f(x) = K(x, L) a + b, and since K is a scalar product of subsequence features,
the landmarks can be summed up: f(x) = <W, features of x> + b with W the sum of a_l times the features of landmark l. So
prediction costs one table look-up for each subsequence, whatever the number of landmarks.

**Training** runs on the driver on a bounded sample, ``SAMPLE`` labelled documents of each class outside the held-out part
(smallest hash of the id first). Sentences carry the label of their document. A toxic document has clean sentences and
words as well, so the machine alternates (multiple instances): the strongest units of each toxic document stand for it,
the units of sentences of clean documents are negative, refit; of runs, the strongest ones that the machine finds in each
round, besides those that toxic documents hold more often. Documents are scored by their strongest units through
a logistic function, fitted at the classes' own rates.

Prediction sees nothing but the text and covers all of it: one pass, no shuffle; the table W (1 MB) goes with the tasks.

Defined results: null and empty texts, and texts without units, get the score of a text without any sign; without
labelled rows of both classes every score is the share of toxic labels (0 without labels); null ids aren't held out;
repeated rows are scored alike; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import held_out, sized, table
from riskframe.llm.registry import register
from riskframe.llm.words import slices

SAMPLE, LANDMARKS, ROUNDS, PENALTY, HARD = 1500, 320, 3, 1e-5, 4000
#: Likelihood ratio from which a unit stands for toxic documents at first.
SURPLUS = 15.0
#: How many times more often toxic documents must hold a beginning than clean ones.
LIFT = 8
DECAY, REACH, STRETCH, CUT = 0.7, 7, 32, 0.3
#: Units that a worker keeps the value of.
KEPT = 700_000
#: Units that are valued together.
CELLS = 512
SYMBOLS = 64
#: Characters whose runs are valued together, and by which parts of a longer text overlap.
LOT, LAP = 100_000, 400
START, END = 0, 63
#: Look-alikes of letters.
ALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_STRIPPED = ".,;:!?-*_"
_SIGNS = re.compile(r"[\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+\s*")


def code(c: str) -> int:
    """a-z are 1 to 26, other letters share 27 to 62."""
    return ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 36


def plain(word: str) -> str:
    """The letters of a lower-case word, look-alikes read as letters where it has letters too."""
    if word.isalpha():
        return word
    if any(map(str.isalpha, word)):
        word = word.strip(".,;:!?\"'()[]{}|*#%&-").translate(ALIKE)
    return _SIGNS.sub("", word)


def spelled(words: list[str]) -> list[str]:
    """Units of runs of three or more one-letter words."""
    one = {x for x in set(words) if len(x) < 2 or ((x[0] in _STRIPPED or x[-1] in _STRIPPED) and len(x.strip(_STRIPPED)) == 1)}
    flags = bytes([x in one for x in words])
    out, at = [], flags.find(b"\1\1\1")
    while at >= 0:
        end = flags.find(b"\0", at)
        end = len(words) if end < 0 else end
        out.append("".join([x if len(x) < 2 else x.strip(_STRIPPED) for x in words[at:end]]))
        at = flags.find(b"\1\1\1", end)
    return out


class _Codes(dict):
    """For ``str.translate``: the character with the code of another one."""

    def __missing__(self, o: int) -> str:
        c = self[o] = chr(code(chr(o)))
        return c


_CODES = _Codes()


def coded_letters(unit: str) -> bytes:
    """One byte for each letter, its code."""
    return unit.translate(_CODES).encode("latin-1")


def cut(unit: str) -> list[bytes]:
    """Codes of a unit with its marks, in overlapping stretches of at most ``STRETCH``."""
    c = b"%c%b%c" % (START, coded_letters(unit), END)
    if len(c) <= STRETCH:
        return [c]
    return [c[i : i + STRETCH] for i in range(0, len(c) - STRETCH // 2, STRETCH // 2)]


def stretches(unit: str) -> list[np.ndarray]:
    """``cut`` as numbers."""
    return [np.frombuffer(c, np.uint8).astype(np.int64) for c in cut(unit)]


class Triples:
    """Places (i, j, k) and weights of the three-character subsequences of a stretch, by its length."""

    def __init__(self):
        self.by_length: dict[int, tuple] = {}

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if n not in self.by_length:
            at = [(i, j, k) for i in range(n) for k in range(i + 2, min(n, i + REACH)) for j in range(i + 1, k)]
            i, j, k = np.array(at or [(0, 0, 0)]).T
            w = DECAY ** (k - i + 1.0) if at else np.zeros(1)
            self.by_length[n] = i, j, k, (w / max(1e-9, np.sqrt((w * w).sum()))).astype(np.float32)
        return self.by_length[n]


def features(codes: np.ndarray, triples: Triples) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence numbers (n x T) and weights (T) of n stretches of one length."""
    i, j, k, w = triples(codes.shape[1])
    return (codes[:, i] * SYMBOLS + codes[:, j]) * SYMBOLS + codes[:, k], w


class Machine:
    """The trained machine: table W, offset b, and the logistic function of a document's strongest units."""

    def __init__(self, w: np.ndarray, b: float, curve: tuple[float, ...]):
        self.w, self.b, self.curve = w.astype(np.float32), b, curve
        self.triples, self.known, self.codes = Triples(), {}, {}

    def __getstate__(self):
        return self.w, self.b, self.curve

    def __setstate__(self, state):
        self.__init__(*state)

    def values(self, units: list[str]) -> np.ndarray:
        """f of each unit; of a long one its largest stretch."""
        out = np.full(len(units), -np.inf)
        by_length: dict[int, tuple[list, list]] = {}
        for at, u in enumerate(units):
            for c in cut(u):
                own = by_length.setdefault(len(c), ([], []))
                own[0].append(at)
                own[1].append(c)
        for n, (at, codes) in by_length.items():
            for s in range(0, len(at), CELLS):
                some = np.frombuffer(b"".join(codes[s : s + CELLS]), np.uint8).reshape(-1, n).astype(np.intp)
                number, weight = features(some, self.triples)
                np.maximum.at(out, at[s : s + CELLS], self.w[number] @ weight + self.b)
        return out

    def coded(self, word: str) -> bytes:
        """Codes of a lower-case word and END, or nothing for one without letters; START where it ends a sentence."""
        unit = plain(word)
        return (b"%b%c" % (coded_letters(unit), END) if unit else b"") + bytes([START]) * (word[-1] in ".!?")

    def runs(self, texts: list[str]) -> Runs:
        """Values of the runs of the texts' sentences."""
        lines, bound = [], []
        for t in texts:
            n = 0
            for line in t.lower().split("\n"):
                words = line.split()
                try:
                    got = b"".join([self.codes[x] for x in words]) + bytes([START])
                except KeyError:
                    missing = {x for x in words if x not in self.codes}
                    if len(self.codes) + len(missing) > KEPT // 2:
                        self.codes, missing = {}, set(words)
                    self.codes.update([(x, self.coded(x)) for x in missing])
                    got = b"".join([self.codes[x] for x in words]) + bytes([START])
                lines.append(got)
                n += len(got)
            bound.append(n)
        return Runs(self, np.frombuffer(b"".join(lines), np.uint8), np.cumsum(bound))

    def learn(self, words: set[str]) -> None:
        """Values of the words that aren't known yet, all at once; ``KEPT`` are kept at most, but for those asked for."""
        missing = [x for x in words if x not in self.known]
        if not missing:
            return
        if len(self.known) + len(missing) > KEPT:
            self.known, missing = {}, list(words)
        units = [plain(x) for x in missing]
        some = [(x, u) for x, u in zip(missing, units) if len(u) > 1]
        self.known.update(dict.fromkeys(missing, -9.0))
        self.known.update(zip([x for x, _ in some], self.values([u for _, u in some]).tolist()))

    def strongest(self, texts: list[str | None]) -> list[tuple[float, float]]:
        """For each text the largest value of its words, and the sum of the positive ones (each once)."""
        out = []
        for a, b in slices([t or "" for t in texts], LOT):
            units = []
            for t in texts[a:b]:
                low = (t or "").lower().split()
                more = spelled(low) if sum(map((1).__eq__, map(len, low))) > 2 else ()
                units.append((set(low), more))
            self.learn(set().union(*(w for w, _ in units), *(m for _, m in units)))
            for words, more in units:
                got = [self.known[x] for x in words]
                got += [self.known[x] for x in more]
                out.append((max(got, default=-9.0), sum([v for v in got if v > 0])))
        return out

    def signs(self, texts: list[str | None]) -> np.ndarray:
        """For each text the largest value of its words and runs, and the sum of the positive ones (each once)."""
        out = np.array(self.strongest(texts), dtype=float).reshape(-1, 2)
        pieces = [(i, p) for i, t in enumerate(texts) for p in parts(t or "")]
        seen: set[tuple[int, bytes]] = set()
        for a, b in slices([p for _, p in pieces], LOT):
            runs = self.runs([p for _, p in pieces[a:b]])
            for at, value, letters, extra in runs.positive():
                i = pieces[a + at][0]
                out[i, 0] = max(out[i, 0], value)
                if extra and (i, letters) not in seen:
                    seen.add((i, letters))
                    out[i, 1] += value
            own = np.array([i for i, _ in pieces[a:b]])
            np.maximum.at(out[:, 0], own, runs.by_text())
        return out

    def score(self, signs: np.ndarray) -> np.ndarray:
        """Probability of each row (strongest value, sum of positive values)."""
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a * np.clip(signs[:, 0], -3, 1) + b * np.minimum(signs[:, 1], 5) + c, -30, 30)))


class Runs:
    """Values of all runs of a batch: neighbouring words of a sentence read as one unit, ``STRETCH`` codes with its marks at
    most. ``at`` is the number of each word's text; ``best`` and ``words``: value and number of words of the strongest run
    of two or more that starts at a word.

    A run's value is a sum over its subsequences, so running sums over all letters give every run's at once; what the marks
    add depends on the six letters beside them."""

    def __init__(self, machine: Machine, raw: np.ndarray, bound: np.ndarray):
        letter = (raw > START) & (raw < END)
        last = np.flatnonzero(raw == END)
        c = np.concatenate([raw[letter].astype(np.intp), np.zeros(REACH, np.intp)])  # room to read beyond the end
        ends = np.cumsum(letter)[last]
        starts = np.concatenate([[0], ends])[:-1].astype(np.int64)
        sentence = np.cumsum(raw == START)[last]
        self.at, self.n_texts = np.searchsorted(bound, last, side="right"), len(bound)
        self.best, self.words = np.full(len(ends), -9.0, np.float32), np.ones(len(ends), np.int64)
        n, w = len(c) - REACH, machine.w
        # Sums over the subsequences within the letters before x that start before letter x (``open_``) or end before it.
        open_, shut = np.zeros(n + 1), np.zeros(n + 1)
        pairs = [(c[:n] * SYMBOLS + c[j : n + j]) * SYMBOLS for j in range(1, REACH - 1)]
        number, got = np.empty(n, np.intp), np.empty(n, np.float32)
        for d in range(2, REACH):
            g = np.zeros(n, np.float32)
            for j in range(1, d):
                np.add(pairs[j - 1], c[d : n + d], out=number)
                g += w.take(number, out=got, mode="clip")
            total = np.concatenate([[0.0], np.cumsum(g, dtype=np.float64)]) * DECAY ** (d + 1)
            open_ += total
            shut[d:] += total[: max(0, n + 1 - d)]
        head, tail = np.zeros(len(starts)), np.zeros(len(ends))
        after, before = [c[starts + j] for j in range(REACH - 1)], [c[ends - j] for j in range(1, REACH)]
        for k in range(2, REACH):
            for j in range(1, k):
                head += w.take(after[j - 1] * SYMBOLS + after[k - 1]) * DECAY ** (k + 1)
                tail += w.take((before[k - 1] * SYMBOLS + before[j - 1]) * SYMBOLS + END) * DECAY ** (k + 1)
        head, tail = head - open_[starts], tail + shut[ends]
        first, m = np.arange(len(starts)), 1
        while len(first):
            m += 1
            first = first[first + m - 1 < len(starts)]
            end = first + m - 1
            s, e = starts[first], ends[end]
            ok = (sentence[first] == sentence[end]) & (e - s <= STRETCH - 2)
            first, end, s, e = first[ok], end[ok], s[ok], e[ok]
            value = (head[first] + tail[end]) * SCALE[e - s + 2] + machine.b
            short = np.flatnonzero(e - s < REACH - 1)
            for size in range(2, REACH - 1):  # subsequences of the marks run over the whole of a short one
                if len(at := short[e[short] - s[short] == size]):
                    codes = np.column_stack([np.full(len(at), START), *(c[s[at] + i] for i in range(size)), np.full(len(at), END)])
                    number, weight = features(codes, machine.triples)
                    value[at] = w[number] @ weight + machine.b
            more = value > self.best[first]
            self.best[first[more]], self.words[first[more]] = value[more], m
        self.machine, self.letters, self.starts, self.ends = machine, c, starts, ends

    def alone(self, i: int) -> float:
        """The value of one word."""
        codes = np.concatenate([[START], self.letters[self.starts[i] : self.ends[i]], [END]])
        if len(codes) < 4:
            return -9.0
        number, weight = features(codes[None, :], self.machine.triples)
        return float((self.machine.w[number] @ weight)[0]) + self.machine.b

    def positive(self) -> Iterator[tuple[int, float, bytes, bool]]:
        """(text, value, letters, whether no positive word and no stronger run overlaps) of positive runs, strongest first."""
        taken: set[int] = set()
        at = np.flatnonzero(self.best > 0)
        for i in at[np.argsort(-self.best[at], kind="stable")].tolist():
            m = int(self.words[i])
            some, s, e = range(i, i + m), self.starts[i], self.ends[i + m - 1]
            # Runs of single letters count as a spelled word already.
            free = not (taken.intersection(some) or any(self.alone(x) > 0 for x in some) or (m > 2 and e - s == m))
            taken.update(some)
            yield int(self.at[i]), float(self.best[i]), self.letters[s:e].astype(np.uint8).tobytes(), free

    def by_text(self) -> np.ndarray:
        """The largest value of each text's runs."""
        out = np.full(self.n_texts, -9.0)
        some = np.flatnonzero(np.diff(self.at, prepend=-1))
        if len(some):
            out[self.at[some]] = np.maximum.reduceat(self.best, some)
        return out


def norm(n: int) -> float:
    """Length of the subsequence weights of n codes."""
    return max(1e-9, float(np.sqrt(sum((k - 1) * max(0, n - k) * DECAY ** (2 * (k + 1.0)) for k in range(2, REACH)))))


#: One over the length of the weights of n codes.
SCALE = np.array([0.0] + [1 / norm(n) for n in range(1, STRETCH + 1)])


def parts(text: str) -> Iterator[str]:
    """A text, in overlapping parts of whole words where it is longer than ``LOT``."""
    for a in range(0, max(1, len(text)), LOT):
        s = text[a : a + LOT + LAP]
        if a:
            s = (s.split(None, 1) + [""] * 2)[1] if not s[:1].isspace() else s
        if a + LOT + LAP < len(text) and not s[-1:].isspace():
            s = (s.rsplit(None, 1) + [""])[0]
        yield s


def neighbours(words: list[str]) -> Iterator[str]:
    """Every run of a sentence's words."""
    for i in range(len(words)):
        n, m = len(words[i]), 1
        while i + m < len(words) and n + len(words[i + m]) <= STRETCH - 2:
            n, m = n + len(words[i + m]), m + 1
            yield "".join(words[i : i + m])


def worded(text: str) -> list[list[str]]:
    """The words of each sentence, as runs are made of them."""
    out: list[list[str]] = [[]]
    for line in text.lower().split("\n"):
        for x in line.split():
            if unit := plain(x):
                out[-1].append(unit)
            if x[-1] in ".!?":
                out.append([])
        out.append([])
    return [s for s in out if s]


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float) -> np.ndarray:
    """Squared-hinge support vector machine by Newton steps; the last column of x is the offset's 1."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(30):
        inside = y * (x @ w) < 1
        xs, ys, cs = x[inside], y[inside], weight[inside]
        new = np.linalg.solve((xs * cs[:, None]).T @ xs + np.diag(ridge), (xs * cs[:, None]).T @ ys)
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w


def fit_curve(signs: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Logistic regression on (strongest value, sum of positive values), by Newton steps."""
    x = np.column_stack([np.clip(signs[:, 0], -3, 1), np.minimum(signs[:, 1], 5), np.ones(len(y))])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + 1e-3 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3)
        w = w - np.linalg.solve(h, g)
    return tuple(float(v) for v in w)


def lead(n: int, n1: int, m: int, n0: int) -> float:
    """Log-likelihood ratio of n of n1 toxic against m of n0 clean documents; 0 where the clean ones have more."""
    if n * n0 <= m * n1:
        return 0.0
    p = (n + m) / (n1 + n0)

    def part(k: int, of: int) -> float:
        return sum(v * np.log(v / of / q) for v, q in ((k, p), (of - k, 1 - p)) if v)

    return 2 * float(part(n, n1) + part(m, n0))


def sentences(text: str) -> list[list[str]]:
    """Units of each sentence."""
    out = []
    for s in _SENTENCE.split(text.lower()):
        words = s.split()
        units = [u for u in map(plain, words) if len(u) > 1] + spelled(words)
        if units:
            out.append(units)
    return out


def stems(unit: str) -> list[str]:
    """Beginnings of a longer unit, marked so that they aren't units."""
    return [unit[:n] + "*" for n in (4, 5, 6) if len(unit) > n]


def groups_of(docs: list[list[str]], most: int = 15, share: float = 0.3, alike: float = 0.4) -> list[int]:
    """A number for each document of the sample, equal for copies: documents with the same units; with a similarity of
    ``alike`` of their sets of units (six shared ones at least), however many hold them; and those that share ``share`` of
    their rarer units (at most ``most`` holders)."""
    first: dict[tuple, int] = {}
    same = [first.setdefault(tuple(d), i) for i, d in enumerate(docs)]
    holders: dict[str, list[int]] = {}
    for i in first.values():
        for u in docs[i]:
            holders.setdefault(u, []).append(i)
    rare, together = Counter(), Counter()
    for at in holders.values():
        if 1 < len(at) <= most:
            rare.update(at)
            together.update((a, b) for n, b in enumerate(at) for a in at[:n])
    group = list(range(len(docs)))

    def find(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    for (a, b), n in together.items():
        if n > 5 and n >= share * min(rare[a], rare[b]):
            group[find(b)] = find(a)
    size = np.array([len(d) for d in docs], dtype=np.int64)
    by_unit = {u: np.array(at) for u, at in holders.items() if len(at) > 1}
    for i in first.values():
        if shared := [by_unit[u] for u in docs[i] if u in by_unit]:
            n = np.bincount(np.concatenate(shared), minlength=len(docs))
            for j in np.flatnonzero((n > 5) & (n >= alike * (size[i] + size - n))).tolist():
                group[find(j)] = find(i)
    return [find(i) for i in same]


def support(pool: list[str], landmarks: list[str], witness: Counter, in_clean: Counter, ratio: float) -> tuple[np.ndarray, float]:
    """Table W and offset of the machine on Nyström features of ``landmarks``: ``witness`` counts the toxic documents of a
    positive unit, ``in_clean`` the clean ones of any unit of the pool; ``ratio``: toxic documents for each clean one."""
    triples, blank = Triples(), np.zeros(SYMBOLS**3, dtype=np.float32)
    own, parts = [], [c for u in landmarks for c in stretches(u)]
    for c in parts:
        number, weight = features(c[None, :], triples)
        own.append((number[0], weight))

    def against(codes: list[np.ndarray]) -> np.ndarray:
        """K(stretches, stretches of the landmarks)."""
        by_length: dict[int, list[int]] = {}
        for i, c in enumerate(codes):
            by_length.setdefault(len(c), []).append(i)
        number = {n: features(np.array([codes[i] for i in at]), triples) for n, at in by_length.items()}
        out = np.zeros((len(codes), len(own)))
        for m, (sub, weight) in enumerate(own):
            np.add.at(blank, sub, weight)
            for n, at in by_length.items():
                out[at, m] = blank[number[n][0]] @ number[n][1]
            blank[sub] = 0
        return out

    table_ = np.zeros(SYMBOLS**3)
    if not landmarks or not witness:
        return table_, -1.0
    values, vectors = np.linalg.eigh(against(parts))
    root = vectors / np.sqrt(np.maximum(values, 1e-4))  # K(L, L)^(-1/2), up to a rotation
    split = [stretches(u) for u in pool]
    pool = [u for u, cs in zip(pool, split) for _ in cs]  # a long unit stands there with each of its stretches
    x = np.column_stack([against([c for cs in split for c in cs]) @ root, np.ones(len(pool))])
    plus = np.array([i for i, u in enumerate(pool) if witness[u]])
    minus = np.array([i for i, u in enumerate(pool) if in_clean[u]], dtype=np.int64)
    # A unit counts as often as documents of its class hold it, but no more than a few times; both sides weigh the same.
    up = np.minimum([float(witness[pool[i]]) for i in plus], 20)
    down = np.minimum([in_clean[pool[i]] * ratio for i in minus], 20)
    y = np.concatenate([np.ones(len(plus)), -np.ones(len(minus))])
    w = fit_linear(x[np.concatenate([plus, minus])], y, np.concatenate([up / up.sum(), down / max(1e-9, down.sum())]), PENALTY)
    for a, (sub, weight) in zip(root @ w[:-1], own):
        np.add.at(table_, sub, a * weight)
    return table_, float(w[-1])


def leading_runs(texts: list[str], toxic: np.ndarray, group: list[int], alone: set[str], g1: int, g0: int) -> dict[str, float]:
    """Likelihood ratios of runs that toxic documents hold more often than clean ones."""

    def of(text: str) -> Iterator[str]:
        # A leading word ends the run of words that are looked at.
        for s in worded(text):
            cuts = [-1, *(i for i, u in enumerate(s) if u in alone), len(s)]
            for a, b in zip(cuts, cuts[1:]):
                yield from neighbours(s[a + 1 : b])

    # Only numbers of the runs are kept until it is known which of them repeat.
    numbers = [np.unique(np.fromiter((hash(u) for u in of(t or "")), np.int64)) for t, y in zip(texts, toxic) if y]
    held, count = np.unique(np.concatenate(numbers), return_counts=True)
    often = set(held[count > 1].tolist())
    in_toxic, in_clean = Counter(), Counter()
    for c, total in ((True, in_toxic), (False, in_clean)):
        members: dict[int, list[str]] = {}
        for t, y, g in zip(texts, toxic, group):
            if y == c:
                members.setdefault(g, []).append(t or "")
        for own in members.values():
            total.update({u for t in own for u in of(t) if hash(u) in often})
    return {u: v for u, n in in_toxic.items() if (v := lead(n, g1, in_clean[u], g0)) > SURPLUS}


def strong_runs(machine: Machine, texts: list[str], least: float = -0.7) -> list[tuple[float, str, int]]:
    """(value, run, text) of the strongest runs of the texts, some thousands."""
    out = []
    pieces = [(i, p) for i, t in enumerate(texts) for p in parts(t or "")]
    for a, b in slices([p for _, p in pieces], LOT):
        runs = machine.runs([p for _, p in pieces[a:b]])
        words = [u for _, p in pieces[a:b] for s in worded(p) for u in s]
        at = np.flatnonzero(runs.best > least)
        out += [(float(runs.best[n]), "".join(words[n : n + runs.words[n]]), pieces[a + int(runs.at[n])][0]) for n in at.tolist()]
    return sorted(out, key=lambda x: (-x[0], x[1:]))[: 4 * HARD]


def fit(texts: list[str], toxic: np.ndarray, rates: tuple[float, float], seed: int = 5) -> Machine:
    """``rates``: the share of toxic and of clean labels in all labelled rows, for the logistic function."""
    r = np.random.default_rng(seed)
    docs = [sorted({u for s in sentences(t or "") for u in s}) for t in texts]
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    if not n1 or not n0:
        share = min(max(rates[0], 1e-6), 1 - 1e-6)
        return Machine(np.zeros(SYMBOLS**3), 0.0, (0.0, 0.0, float(np.log(share / (1 - share)))))
    # Copies of a document count once, or all of a copied document's words would seem to go with its label.
    group = groups_of(docs)
    g1, g0 = (len({g for g, t in zip(group, toxic) if t == c}) for c in (True, False))
    in_toxic = Counter(u for u, _ in {(u, g) for d, t, g in zip(docs, toxic, group) if t for u in d})
    in_clean = Counter(u for u, _ in {(u, g) for d, t, g in zip(docs, toxic, group) if not t for u in d})
    # Start: the units that toxic documents hold more often than chance explains (likelihood ratio).
    # A unit also leads by its beginning: insults come in many forms, each of them rare.
    in_toxic_stem = Counter(x for x, _ in {(x, g) for d, t, g in zip(docs, toxic, group) if t for u in d for x in stems(u)})
    in_clean_stem = Counter(x for x, _ in {(x, g) for d, t, g in zip(docs, toxic, group) if not t for u in d for x in stems(u)})
    by_stem = {x: lead(n, g1, in_clean_stem[x], g0) for x, n in in_toxic_stem.items() if n > 2 and n * g0 > LIFT * (in_clean_stem[x] + 1) * g1}
    surplus = {u: max([lead(n, g1, in_clean[u], g0) if n > 1 else 0.0, *(by_stem.get(x, 0.0) for x in stems(u))]) for u, n in in_toxic.items()}
    # Runs that toxic documents hold more often, without those that hold a leading word.
    alone = {u for u, v in surplus.items() if v > SURPLUS}
    surplus |= leading_runs(texts, toxic, group, alone, g1, g0)
    leading = sorted(surplus, key=lambda u: (-surplus[u], u))
    positive = [u for u in leading if surplus[u] > SURPLUS]
    known = set(positive)
    common = sorted(in_clean, key=lambda u: (-in_clean[u], u))[:2000]
    rare = sorted(set(in_clean) - set(common))
    clean = common + rare
    hard = [rare[i] for i in r.permutation(len(rare))[:HARD]]
    # Positive units with a character more, as people write them to get past a word list.
    inserted = Counter(u[:i] + "abcdefghijklmnopqrstuvwxyz"[r.integers(26)] + u[i:] for u in positive[: LANDMARKS // 2] if len(u) > 3 for i in range(1, len(u)))
    inserted = Counter({u: 0.02 for u in inserted if not in_clean[u]})
    extra, strong = inserted, Counter()
    for _ in range(ROUNDS):
        pool = list(dict.fromkeys([*positive, *extra, *common, *hard, *strong, *(rare[i] for i in r.permutation(len(rare))[:HARD])]))
        landmarks = list(dict.fromkeys([*positive[: LANDMARKS // 2], *hard[: LANDMARKS // 2]]))
        machine = Machine(*support(pool, landmarks, Counter({u: max(in_toxic[u], 2) for u in positive}) + extra, in_clean + strong, g1 / g0), (0.0, 0.0, 0.0))
        # Next: clean units closest to the border as landmarks and negatives; the best unit of each toxic document that
        # none of the first ones explains, if the machine takes it for one.
        values = machine.values(clean)
        hard = [clean[i] for i in np.argsort(-values, kind="stable")[:HARD]]
        extra = Counter(inserted)
        found = set()
        for d, t, g in zip(docs, toxic, group):
            if t and d and not known.intersection(d):
                v = machine.values(d)
                if v.max() > 0.5:
                    found.add((d[int(v.argmax())], g))
        # The same for runs: the strongest ones of clean sentences are negative, those of unexplained documents stand for them.
        close = strong_runs(machine, texts)
        strong += Counter(u for u, _ in sorted({(u, group[i]) for v, u, i in close if not toxic[i]}))
        explained = {g for _, g in found} | {g for d, t, g in zip(docs, toxic, group) if t and known.intersection(d)}
        best = {}
        for v, u, i in close:
            if toxic[i] and v > max(0.5, best.get(group[i], (0.5, ""))[0]) and group[i] not in explained and not strong[u]:
                best[group[i]] = (v, u)
        extra.update(u for u, _ in found)
        extra.update(u for _, u in best.values())
    signs = machine.signs(texts)
    weight = np.where(toxic, rates[0] / n1, rates[1] / n0) * len(texts)
    machine.curve = fit_curve(signs, toxic.astype(float), weight)
    return machine


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Machine:
    """A machine from ``sample`` labelled documents of each class outside the held-out part."""
    ident = F.col(f"`{id_col}`").cast("bigint")
    marked = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    marked = marked.groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    total = max(1, sum(counts.values()))
    rates = (counts.get(1, 0) / total, counts.get(0, 0) / total)
    # At most ``sample`` ids of each class: first of each class and part, then of the class (parts times sample rows).
    ids = marked.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64)))
    for by in (["toxic", "part"], ["toxic"]):
        order = Window.partitionBy(*by).orderBy(F.xxhash64("id"), "id")
        ids = ids.withColumn("no", F.row_number().over(order)).where(F.col("no") <= sample).drop("no")
    ids = ids.select("id", "toxic")
    texts = docs.select(ident.alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    got = texts.join(sized(ids, "toxicity-sample"), "id").select("id", "toxic", "text").sort("id", "text").collect()
    return fit([r["text"] for r in got], np.array([r["toxic"] == 1 for r in got], dtype=bool), rates)


def scored(text: Column, machine: Machine) -> Column:
    """Probability column of a text column."""

    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(machine.score(machine.signs(list(texts))))

    return udf(text.cast("string"))


def score(docs: DataFrame, labels: DataFrame | None = None, machine: Machine | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row; trains on ``labels`` unless a machine is given."""
    machine = train(docs, labels, id_col, text_col) if machine is None else machine
    ident = F.col(f"`{id_col}`").cast("bigint")
    rows = docs.select(ident.alias("doc_id"), held_out(ident).alias("held_out"), scored(F.col(f"`{text_col}`"), machine).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


@register("op8_toxicity")
def op8_toxicity(spark, sf_dir) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
