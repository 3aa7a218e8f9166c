"""Toxicity: noisy-channel restoration of disguised words, then a learned score of the restored text.

A writer's word passes a channel that may replace letters by look-alikes (l0ser), stretch them
(looooser) or space them out (l o s e r). Words that could have passed it span a lattice of letters;
in spaced-out letters every sign between two may be nothing or the end of a word;
a Viterbi search picks the path that is likeliest under a character trigram model counted over all
documents, mixed with the counts of the commonest words, times the channel's costs. Spaced-out letters are also
read as one word from one wide gap to the next; both readings count. All other words have a lattice of one path
and stay as they are.

Restored words give features: the squeezed word and its prefixes. A logistic regression over features
that mark toxic documents is fitted on a bounded, documented sample of labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import id_remainder, labelled_sample
from kerbside.session import stage

# Look-alikes and the letters they may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "li", "+": "t",
}

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Symbols of the character model: a word's edge, the letters, and one for any digit or sign left as it is.
EDGE, OTHER = 0, 27
SYMBOLS = 28

LEET_COST = 1.0  # of a look-alike, in nats
STRETCH_COST = 1.0  # of a letter stretched to three or more
REPEAT_COST = 0.75  # of a spaced-out letter that only repeats the one before it
JOIN_COST = 0.5  # of a sign between single letters that joins them, and of each that is wider than the narrowest
BREAK_COST = 0.5  # of a narrowest sign between spaced letters that ends a word; wider ones end it at no cost
DROP_COST = 2.0  # of a sign that stands for nothing
KNOWN_COST, UNKNOWN_COST = 0.1, 2.3  # of a word being one of the known words or any other: shares 0.9 and 0.1
#: No word of the word model, and no second reading of spaced-out letters, is longer.
LONGEST_WORD = 32
#: Decoded pieces up to this length are remembered.
REMEMBERED = 256

# Letters of other scripts that look like a Latin one.
SCRIPT_LOOK_ALIKES = {
    "\u0430": "a", "\u0435": "e", "\u043e": "o", "\u0440": "p", "\u0441": "c", "\u0443": "y", "\u0445": "x", "\u0456": "i",
    "\u0458": "j", "\u0455": "s", "\u0501": "d", "\u04bb": "h", "\u051b": "q", "\u051d": "w", "\u043a": "k", "\u043c": "m",
    "\u0442": "t", "\u043d": "h", "\u0432": "b", "\u03b1": "a", "\u03b5": "e", "\u03b9": "i", "\u03bf": "o", "\u03c1": "p",
    "\u03c5": "u", "\u03bd": "v", "\u03ba": "k", "\u03c4": "t", "\u0131": "i",
}

#: The byte that any Latin-1 byte folds to: lower case, no marks, a space for what is no ASCII character then.
_FOLD = bytes(
    ord(c) if (c := unicodedata.normalize("NFKD", chr(i).lower())[0]).isascii() else ord("s") if c == "ß" else 32
    for i in range(256)
)
_INVISIBLE = re.compile("[\xad\u200b-\u200d\u2060\ufeff]")
_MARKS = re.compile("[\u0300-\u036f]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_OTHER_SCRIPT = re.compile(f"[{''.join(SCRIPT_LOOK_ALIKES)}]")
_SCRIPT_TABLE = str.maketrans(SCRIPT_LOOK_ALIKES)


def _one_script(word: re.Match) -> str:
    """A word with Latin letters in it, with the letters it borrows from other scripts replaced."""
    return word[0].translate(_SCRIPT_TABLE) if any("a" <= c <= "z" for c in word[0]) else word[0]


def plain(text: str | None) -> bytes:
    """Lower-case ASCII bytes of a text, without marks on letters and without invisible characters."""
    text = text or ""
    if text.isascii():
        return text.lower().encode()
    text = _INVISIBLE.sub("", text)
    try:
        return text.encode("latin-1").translate(_FOLD)
    except UnicodeEncodeError:
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower()
        if _OTHER_SCRIPT.search(text):
            text = _LETTERS.sub(_one_script, text)
        return text.encode("latin-1", "replace").translate(_FOLD)


# --- the character model -------------------------------------------------------------------------


_CODES = np.full(256, EDGE, dtype=np.int32)
for _i, _c in enumerate(LETTERS):
    _CODES[ord(_c)] = _i + 1
for _c in LOOK_ALIKES:
    if _c not in "!|+":
        _CODES[ord(_c)] = OTHER
#: Kinds of bytes: 1 letter, 2 look-alike, 3 what may stand between spaced-out letters, 0 anything else.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[ord(c) for c in LETTERS]] = 1
_KIND[[ord(c) for c in LOOK_ALIKES]] = 2
_KIND[[ord(c) for c in " \t\r\n._*-/\\,;:~'\"#"]] = 3
#: Bytes of text looked at in one go.
BLOCK_BYTES = 1 << 20


def _blocks(texts: list[bytes]) -> Iterator[tuple[list[int], bytes]]:
    """Runs of whole texts of about BLOCK_BYTES, each after three spaces, and where they start; three spaces end a block."""
    starts, parts, size = [], [], 0
    for t in texts:
        starts.append(size + 3)
        parts.append(t)
        size += len(t) + 3
        if size >= BLOCK_BYTES:
            yield starts, b"   " + b"   ".join(parts) + b"   "
            starts, parts, size = [], [], 0
    if parts:
        yield starts, b"   " + b"   ".join(parts) + b"   "


def _trigrams(block: bytes) -> np.ndarray:
    s = _CODES[np.frombuffer(block, dtype=np.uint8)]
    return (s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]


#: A task hands its word counts on when it holds this many.
HELD_WORDS = 100_000


def _words(block: bytes) -> Iterable[bytes]:
    """Words of a block; as a stream where one text makes it very long."""
    return _WORD.findall(block) if len(block) < 8 * BLOCK_BYTES else (m[0] for m in _WORD.finditer(block))


def corpus_counts(documents: DataFrame) -> DataFrame:
    """(trigram, word, n) over the whole texts of all documents: SYMBOLS**3 rows of trigrams at most (word NULL),
    and one for each word of LONGEST_WORD letters at most (trigram NULL)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        words: Counter[bytes] = Counter()

        def rows(trigram: Iterable, word: Iterable, n: Iterable) -> pd.DataFrame:
            columns = {"trigram": trigram, "word": word, "n": n}
            return pd.DataFrame({name: pd.Series(list(values), dtype=object) for name, values in columns.items()})

        def counted() -> pd.DataFrame:
            some = [(w.decode(), n) for w, n in words.items() if len(w) <= LONGEST_WORD]
            words.clear()
            return rows([None] * len(some), (w for w, _ in some), (n for _, n in some))

        for batch in batches:
            for _, block in _blocks([plain(t) for t in batch["text"]]):
                total += np.bincount(_trigrams(block), minlength=SYMBOLS**3)
                words.update(_words(block))
                if len(words) >= HELD_WORDS:
                    yield counted()
        yield counted()
        seen = np.flatnonzero(total)
        yield rows(seen.tolist(), [None] * len(seen), total[seen].tolist())

    return (
        documents.select("text")
        .mapInPandas(run, "trigram bigint, word string, n bigint")
        .groupBy("trigram", "word")
        .agg(F.sum("n").alias("n"))
    )


def word_costs(counts: DataFrame, known_words: int) -> dict[str, float]:
    """-log of the share of each of the ``known_words`` commonest words that occur twice or more."""
    words = counts.where(F.col("word").isNotNull())
    total = words.agg(F.sum("n")).first()[0]
    top = words.where(F.col("n") >= 2).orderBy(F.desc("n"), "word").limit(known_words).collect()
    return {r.word: math.log(total / r.n) for r in top}


def character_costs(counts: np.ndarray) -> list[float]:
    """-log p(c | a, b) at index (a, b, c), smoothed by the bigram and unigram shares."""
    cube = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    cube[:, EDGE, EDGE] = 0  # runs of spaces say nothing about words
    unigram = (cube.sum((0, 1)) + 1) / (cube.sum() + SYMBOLS)
    pair = cube.sum(0)
    bigram = (pair + 20 * unigram) / (pair.sum(1, keepdims=True) + 20)
    trigram = (cube + 20 * bigram[None]) / (cube.sum(2, keepdims=True) + 20)
    return (-np.log(trigram)).ravel().tolist()


# --- restoration ---------------------------------------------------------------------------------

_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}


@dataclass
class Restorer:
    """Viterbi decoding of words under the costs of characters and of known words. Keeps a bounded memory of decoded pieces."""

    costs: list[float]
    words: dict[str, float] = field(default_factory=dict)
    memory: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.begins = {w[:k] for w in self.words for k in range(len(w) + 1)}
        self.unknown = UNKNOWN_COST if self.words else 0.0  # without known words the character model stands alone

    def _slots(self, word: str, spaced: bool) -> list[list[tuple[str, float]]]:
        """The lattice: per position, the strings it may stand for, and their channel costs."""
        slots = []
        for run in re.finditer(r"(.)\1*", word):
            c, n = run[1], len(run[0])
            if spaced:
                ways = [(letter, LEET_COST) for letter in LOOK_ALIKES.get(c, "")]
                ways += [("", DROP_COST)] if c in LOOK_ALIKES and not c.isdigit() else [(c, 0.0)]
                slots += [ways, *([[*ways, ("", REPEAT_COST)]] * (n - 1))]
                continue
            if c in LOOK_ALIKES:
                ways = [(letter * k, LEET_COST + 0.5 * (k - 1)) for letter in LOOK_ALIKES[c] for k in (1, 2)[: min(n, 2)]]
                ways += [(c, 0.0)] if c.isdigit() else [("", DROP_COST)]
            elif n >= 3:
                ways = [(c, STRETCH_COST), (c * 2, STRETCH_COST)]
            else:
                ways = [(c * n, 0.0)]
            slots.append(ways)
        return slots

    def _spaced_slots(self, letters: str, join: list[float], part: list[float]) -> list[list[tuple[str, float]]]:
        """The lattice of spaced-out letters: after letter k nothing (at the cost ``join[k]``) or a space (``part[k]``)."""
        slots = self._slots(letters, True)
        between = [[("", j), (" ", p)] for j, p in zip(join, part, strict=True)]
        return [s for pair in zip(slots, [*between, []], strict=True) for s in pair][:-1]

    def _remembered(self, piece: str, decoder) -> str:
        known = self.memory.get(piece)
        if known is None:
            known = decoder(piece)
            if len(piece) <= REMEMBERED:
                if len(self.memory) > 50_000:  # a cache only: what is forgotten is decoded again
                    self.memory.clear()
                self.memory[piece] = known
        return known

    def decode(self, word: str) -> str:
        return self._remembered(word, lambda w: self._likeliest(self._slots(w, False))[1])

    def _likeliest(self, slots: list[list[tuple[str, float]]]) -> tuple[float, str]:
        """Cost and text of the best path; a space in it ends a word and begins another.

        A word on its way is either any word, priced letter by letter (its last two symbols are the state), or the
        beginning of known words, priced when it ends. States point back to the letters before them.
        """
        costs, code, begins, words = self.costs, _CODE, self.begins, self.words
        State = tuple[float, tuple | None]
        free: dict[tuple[int, int], State] = {(EDGE, EDGE): (0.0, None)}
        known: dict[str, State] = {"": (0.0, None)} if words else {}

        def ended() -> State:
            every = [(cost + costs[(a * SYMBOLS + b) * SYMBOLS + EDGE] + self.unknown, at) for (a, b), (cost, at) in free.items()]
            every += [(cost + words[w] + KNOWN_COST, at) for w, (cost, at) in known.items() if w in words]
            return min(every, key=lambda state: state[0])

        for ways in slots:
            free_after: dict[tuple[int, int], State] = {}
            known_after: dict[str, State] = {}
            for letters, price in ways:
                if letters == " ":
                    cost, at = ended()
                    state = (cost + price, (at, " "))
                    if (EDGE, EDGE) not in free_after or state[0] < free_after[EDGE, EDGE][0]:
                        free_after[EDGE, EDGE] = state
                    if words and ("" not in known_after or state[0] < known_after[""][0]):
                        known_after[""] = state
                    continue
                for (a, b), (cost, at) in free.items():
                    x, y, total = a, b, cost + price
                    for c in letters:
                        z = code.get(c, OTHER)
                        total += costs[(x * SYMBOLS + y) * SYMBOLS + z]
                        x, y = y, z
                    best = free_after.get((x, y))
                    if best is None or total < best[0]:
                        free_after[x, y] = (total, (at, letters) if letters else at)
                for w, (cost, at) in known.items():
                    longer = w + letters
                    if longer in begins:
                        best = known_after.get(longer)
                        if best is None or cost + price < best[0]:
                            known_after[longer] = (cost + price, (at, letters) if letters else at)
            free, known = free_after, known_after
        cost, at = ended()
        text = []
        while at:
            at, letters = at
            text.append(letters)
        return cost, "".join(reversed(text))

    def _price(self, words: list[str]) -> float:
        total = 0.0
        for w in words:
            s = [EDGE, EDGE, *(_CODE.get(c, OTHER) for c in w), EDGE]
            free = sum(self.costs[(x * SYMBOLS + y) * SYMBOLS + z] for (x, y), z in zip(pairwise(s), s[2:], strict=False))
            total += min(free + self.unknown, self.words.get(w, math.inf) + KNOWN_COST)
        return total

    def _joined(self, piece: str) -> str:
        """Single letters in a row: the likeliest words of them, if likelier than so many words of one letter, and
        each group between wider gaps as one word."""
        return self._remembered(piece, self._words_of_letters)

    def _words_of_letters(self, piece: str) -> str:
        at = [i for i, c in enumerate(piece) if _KIND[ord(c)] != 3]
        letters = "".join(piece[i] for i in at)
        if not any(c.isalpha() for c in letters):
            return piece
        wider = [b - a for a, b in pairwise(at)]
        least = min(wider)
        wider = [w - least for w in wider]
        join, part = [JOIN_COST * (1 + w) for w in wider], [0.0 if w else BREAK_COST for w in wider]
        cost, text = self._likeliest(self._spaced_slots(letters, join, part))
        if cost >= self._price(list(letters)):
            text = " ".join(letters)
        ends = [0, *(k + 1 for k, w in enumerate(wider) if w), len(letters)]
        groups = [letters[a:b] for a, b in pairwise(ends) if 3 <= b - a <= LONGEST_WORD]
        found = set(text.split())
        whole = dict.fromkeys(self._likeliest(self._slots(g, True))[1] for g in groups)
        return " ".join(["", text, *(w for w in whole if w not in found), ""])

    def _disguised(self, block: bytes, starts: list[int]) -> list[tuple[int, int, bool]]:
        """(start, end, spaced) of the words of a block whose lattice has more than one path, in order."""
        a = np.frombuffer(block, dtype=np.uint8)
        kind = _KIND[a]
        same = a[1:] == a[:-1]
        part = (kind == 1) | (kind == 2)
        spots = np.flatnonzero(same[1:] & same[:-1] & (kind[2:] == 1))
        mixed = kind[1:] + 4 * kind[:-1]
        spots = np.concatenate([spots, np.flatnonzero((mixed == 6) | (mixed == 9))])  # a letter beside a look-alike
        alone = np.flatnonzero(part[1:-1] & ~part[:-2] & ~part[2:]) + 1
        # Neighbours have only signs between them, however many, and are of one text.
        foreign = np.concatenate([[0], np.cumsum(kind != 3)])
        owner = np.searchsorted(starts, alone, side="right")
        near = (foreign[alone[1:]] == foreign[alone[:-1] + 1]) & (owner[1:] == owner[:-1])
        change = np.flatnonzero(np.diff(np.concatenate([[False], near, [False]]).astype(np.int8)))
        found = [(int(alone[i]), int(alone[j]) + 1, True) for i, j in zip(change[::2], change[1::2], strict=True) if j - i >= 2]
        if len(spots):
            edges = np.flatnonzero(~part)
            at = np.unique(np.searchsorted(edges, spots))
            at = at[(at > 0) & (at < len(edges))]
            found += [(int(x) + 1, int(y), False) for x, y in zip(edges[at - 1], edges[at], strict=True)]
            found.sort()
        return found

    def restore_block(self, starts: list[int], block: bytes) -> tuple[list[int], bytes]:
        """The restored block and where its texts start then."""
        out, done, shifts, shift = [], 0, [(0, 0)], 0
        for x, y, spaced in self._disguised(block, starts):
            if x < done or x >= y:
                continue
            piece = block[x:y].decode()
            new = (self._joined(piece) if spaced else self.decode(piece)).encode()
            out += [block[done:x], new]
            done = y
            shift += len(new) - (y - x)
            shifts.append((y, shift))
        out.append(block[done:])
        at = np.searchsorted([p for p, _ in shifts], starts, side="right") - 1
        return [s + shifts[k][1] for s, k in zip(starts, at, strict=True)], b"".join(out)

    def restore(self, text: str | None) -> str:
        """One text restored."""
        (starts, block), = (self.restore_block(*b) for b in _blocks([plain(text)]))
        return block[starts[0] : -3].decode()


# --- scoring -------------------------------------------------------------------------------------

PREFIXES = range(3, 8)
_WORD = re.compile(rb"[a-z]+")
_DOUBLE = re.compile(r"([a-z])\1+")


def squeezed(word: str) -> str:
    return _DOUBLE.sub(r"\1", word)


def word_features(word: str) -> list[str]:
    """The squeezed word between edges, and its prefixes."""
    word = squeezed(word)
    return [f"{word}.", *(word[:k] for k in PREFIXES if k < len(word))]


@dataclass
class ToxicityModel:
    costs: list[float]
    weights: dict[str, float]
    bias: float
    words: dict[str, float] = field(default_factory=dict)

    def restorer(self) -> Restorer:
        return Restorer(self.costs, self.words)

    def heads(self) -> np.ndarray:
        """For each trigram that can begin a word, whether a weighed feature may begin so, letters doubled or not."""
        begins = {f[:k].rstrip(".") for f in self.weights for k in (1, 2, 3)}
        ends = {f.rstrip(".") for f in self.weights if f.endswith(".") and len(f) <= 3}
        names = " " + LETTERS
        heads = np.zeros(SYMBOLS**3, dtype=bool)
        for i, x in enumerate(names[1:], 1):
            for j, y in enumerate(names):
                for k, z in enumerate(names):
                    word = (x + y + z).split(" ")[0]
                    known = squeezed(word) in (begins if " " not in x + y + z else ends)
                    heads[(i * SYMBOLS + j) * SYMBOLS + k] = known
        return heads

    def score_texts(self, texts: list[str | None], restorer: Restorer, heads: np.ndarray) -> list[float]:
        """Scores of some whole texts: each is restored, then its words are looked up."""
        weights, out = self.weights, []
        for starts, block in _blocks([plain(t) for t in texts]):
            starts, block = restorer.restore_block(starts, block)
            codes = _trigrams(block)
            first = _CODES[np.frombuffer(block, dtype=np.uint8)[:-2]]
            begins = np.ones(len(first), dtype=bool)
            begins[1:] = (first[:-1] == EDGE) | (first[:-1] == OTHER)
            spots = np.flatnonzero(begins & heads[codes])
            owner = np.searchsorted(starts, spots, side="right") - 1
            found: list[set[str]] = [set() for _ in starts]
            for p, k in zip(spots.tolist(), owner.tolist(), strict=True):
                word = _WORD.match(block, p)[0].decode()
                found[k].update(f for f in word_features(word) if f in weights)
            for marks in found:
                z = self.bias + math.fsum(weights[f] for f in marks)
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        return out


def _training_rows(sample: DataFrame, costs: list[float], known: dict[str, float]) -> DataFrame:
    """(doc_id, target, features): the distinct features of each sampled document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(costs, known)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = set(re.findall("[a-z]+", restorer.restore(text)))
                rows.append(sorted({f for w in words for f in word_features(w)}))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "target": batch["target"], "features": rows})

    kind = sample.schema["doc_id"].dataType.simpleString()
    return sample.select("doc_id", "target", "text").mapInPandas(run, f"doc_id {kind}, target int, features array<string>")


def _fit_weights(rows: list, names: list[str], n_docs: int, n_toxic: int, epochs: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with non-negative weights on binary features, by accelerated gradient steps."""
    index = {f: i for i, f in enumerate(names)}
    owner = np.array([k for k, (_, fs) in enumerate(rows) for _ in fs], dtype=np.int64)
    which = np.array([index[f] for _, fs in rows for f in fs], dtype=np.int64)
    y = np.array([t for t, _ in rows], dtype=float)
    bare = max(n_docs - len(rows), 0)  # documents without any chosen feature: all but n_toxic - sum(y) of them clean
    bare_toxic = max(n_toxic - y.sum(), 0.0)
    w, bias, vw, vb, n = np.zeros(len(names)), -2.0, np.zeros(len(names)), 0.0, max(n_docs, 1)
    for _ in range(epochs):
        z = bias + np.bincount(owner, weights=w[which], minlength=len(rows)) if len(rows) else np.zeros(0)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        g = p - y
        gw = np.bincount(which, weights=g[owner], minlength=len(names)) / n + 1e-5 * w
        gb = (g.sum() + bare / (1 + math.exp(-bias)) - bare_toxic) / n
        vw, vb = 0.9 * vw - 2.0 * gw, 0.9 * vb - 2.0 * gb
        w, bias = np.maximum(w + vw, 0.0), max(min(bias + vb, 0.0), -8.0)
    return w, bias


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    learnable: Column,
    sample_rows: int = 12_000,
    max_features: int = 4096,
    min_docs: int = 5,
    known_words: int = 50_000,
) -> ToxicityModel:
    """Character model and the ``known_words`` commonest words over all documents; word weights from ``sample_rows``
    labelled rows at most.

    A feature is a candidate if at least ``min_docs`` toxic documents hold it and it is at least 8
    times as frequent among toxic as among clean ones (smoothed); the ``max_features`` that mark most
    toxic documents are weighed. What reaches the driver is bounded by these parameters, not by the data.
    Without toxic examples every score is the bias alone.
    """
    counts = np.zeros(SYMBOLS**3, dtype=np.int64)
    counted = stage(corpus_counts(documents), "toxicity_counts")
    for r in counted.where(F.col("trigram").isNotNull()).collect():  # SYMBOLS**3 rows at most
        counts[r.trigram] = r.n
    costs, words = character_costs(counts), word_costs(counted, known_words)
    sample = labelled_sample(documents, labels, "toxic", learnable, sample_rows)
    rows = stage(_training_rows(sample, costs, words), "toxicity_rows")
    sizes = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("target"), F.lit(0)).alias("toxic")).first()
    n_clean = sizes.n - sizes.toxic
    per_feature = (
        rows.select("target", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("target").alias("toxic"), F.sum(1 - F.col("target")).alias("clean"))
        .where(
            (F.col("toxic") >= min_docs)
            & (F.col("toxic") / max(sizes.toxic, 1) >= 8 * (F.col("clean") + 0.5) / max(n_clean, 1))
        )
        .orderBy(F.desc("toxic"), "feature")
        .limit(max_features)
    )
    names = [r.feature for r in per_feature.collect()]
    if not names:
        return ToxicityModel(costs, {}, math.log((sizes.toxic + 0.5) / (n_clean + 10.0)), words)
    chosen = rows.select(
        "target", F.array_intersect("features", F.array(*[F.lit(f) for f in names])).alias("features")
    ).where(F.size("features") > 0)
    w, bias = _fit_weights([(r.target, r.features) for r in chosen.collect()], names, sizes.n, sizes.toxic)
    return ToxicityModel(costs, {f: float(x) for f, x in zip(names, w, strict=True) if x > 0}, bias, words)


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Score column from 0 to 1; NULL and empty texts get the score of a text without marks."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        restorer, heads = model.restorer(), model.heads()
        for batch in batches:
            yield pd.Series(model.score_texts(list(batch), restorer, heads), dtype="float64")

    return score(text)


def score_toxicity(documents: DataFrame, labels: DataFrame, learnable: Column | None = None, threshold: float = 0.3, **fit) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``documents``; ``learnable`` limits the rows to learn from.

    Repeated rows are scored one by one; NULL ids are scored and never learned from.
    """
    model = fit_toxicity(documents, labels, F.lit(True) if learnable is None else learnable, **fit)
    scored = documents.select("doc_id", toxicity_score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``documents`` without the rows scored ``threshold`` or more; columns unchanged."""
    model = fit_toxicity(documents, labels, id_remainder(F.col("doc_id"), 4) != 2)
    return documents.where(toxicity_score(model, F.col("text")) < threshold)
