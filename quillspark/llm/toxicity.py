"""Toxicity by noisy-channel deobfuscation.

A writer hides words by leetspeak (1d10t), separators and spacing (i.d.i.o.t, "i d i o t") and repetition (idiooot).
Every suspicious token becomes a character lattice - each observed character may stand for itself, for the letters it
resembles, or for nothing - and the Viterbi algorithm finds the likeliest letters under a character trigram model of
the words of all documents. Blanks are arcs of the lattice too: wherever tokens of any length, parted by any blanks or
marks, spell a word the classifier knows, that word is read if the character model finds it likelier than the parts.
The restored words are then scored: a logistic model over the presence of the words that tell the labels apart.

Trigrams are counted over all documents, whole; those of a share under ``LEAST_SHARE`` are left to the back-off, so the
model has at most a million. The classifier's fit takes at most ``per_class`` labelled texts of each class of at most
``max_bytes`` bytes (the documented bounds); scoring takes whole texts and whole tokens.

Defined results: a null or empty text has the model's base score; null doc_ids are scored and not held out; repeated
rows are scored each; without labels of both classes the score is the share of label 1 (0 without labels); a doc_id
labelled both ways is fitted as both; of readings that cost the same the first in the order of the lattice wins.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import as_batch, batches, checkpointed, labelled_sample, sigmoid, sparse_logistic, text_bytes, tokens

#: What a character may stand for besides itself, with the channel's cost.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i"}
#: A mark that resembles no letter is dropped cheaply, one that does and a doubled letter dearly, a third repeat cheaply.
SWAP, DROP_MARK, DROP_LEET, DROP_DIGIT, DROP_DOUBLE, DROP_REPEAT, KEEP_DIGIT = 1.0, 0.5, 5.0, 12.0, 5.0, 0.3, 8.0
#: Lengths of the word beginnings that are features beside whole words.
PREFIXES = (4, 5, 6)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_PLAIN = re.compile(r"[^\W\d_]+")
_TRIPLE, _RUN = re.compile(r"(.)\1\1"), re.compile(r"(.)\1+")
#: Outer marks that most tokens with any have.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
#: Cost of reading over a blank, and the share of all trigrams under which one is left to the back-off.
DROP_BLANK, LEAST_SHARE = 1.0, 1e-6
#: Up to how many characters of a piece of a split word that isn't plain all readings are tried.
PIECE = 3


@dataclass
class CharacterModel:
    """Trigram log-probabilities of words (start twice and end once as a space), with back-off to bigrams."""

    costs: dict[str, float]
    pairs: dict[str, float]
    unknown: float

    def cost(self, before: str, char: str) -> float:
        c = self.costs.get(before + char)
        if c is None:
            c = self.pairs.get(before[1] + char)
            c = self.unknown if c is None else c + 1.5
        return c


def plain(word: str) -> bool:
    """Whether the character model learns from a lower-cased token: letters only, none three times running."""
    return _PLAIN.fullmatch(word) is not None and _TRIPLE.search(word) is None


def trigrams(words: dict[str, int]) -> Counter:
    tri: Counter = Counter()
    for word, n in words.items():
        padded = "  " + word + " "
        for i in range(len(padded) - 2):
            tri[padded[i : i + 3]] += n
    return tri


def fit_characters(words: dict[str, int]) -> CharacterModel:
    return character_model(trigrams(words))


def character_model(tri: dict[str, int]) -> CharacterModel:
    head: Counter = Counter()
    pair: Counter = Counter()
    first: Counter = Counter()
    for t, n in tri.items():
        head[t[:2]] += n
        pair[t[1:]] += n
        first[t[1]] += n
    return CharacterModel({t: -math.log(n / head[t[:2]]) for t, n in tri.items()}, {p: -math.log(n / first[p[0]]) for p, n in pair.items()}, 9.0)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """By observed character, the letters it may stand for ('' for none) and their channel costs."""
    arcs = []
    for i, c in enumerate(token):
        options = []
        if c.isalpha():
            options.append((c, 0.0))
        else:
            options += [(x, SWAP) for x in LEET.get(c, "")]
            options.append(("", DROP_DIGIT if c.isdigit() else DROP_LEET if c in LEET else DROP_MARK))
            if c.isdigit():
                options.append((c, KEEP_DIGIT))
        if i and token[i - 1] == c:
            options.append(("", DROP_REPEAT if token[max(0, i - 2) : i] == c * 2 or token[i + 1 : i + 2] == c else DROP_DOUBLE))
        arcs.append(options)
    return arcs


def viterbi(token: str, model: CharacterModel) -> str:
    """The likeliest word behind ``token``; the cost is in proportion to its length."""
    states: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
    cost = model.cost
    for options in lattice(token):
        new: dict[str, tuple[float, tuple | None]] = {}
        for before, (total, path) in states.items():
            for char, price in options:
                key, value = (before[1] + char, total + price + cost(before, char)) if char else (before, total + price)
                old = new.get(key)
                if old is None or value < old[0]:
                    new[key] = (value, (char, path) if char else path)
        states = new
    _, path = min(((total + cost(before, " "), path) for before, (total, path) in states.items()), key=lambda x: x[0])
    word = []
    while path is not None:
        char, path = path
        word.append(char)
    return "".join(reversed(word))


def spelling(word: str, model: CharacterModel) -> float:
    """What the character model charges for a word."""
    padded = "  " + word + " "
    return sum(model.cost(padded[i : i + 2], padded[i + 2]) for i in range(len(padded) - 2))


def bare(token: str) -> str:
    """A token without its outer marks."""
    if token.isalpha():
        return token
    core = token.strip(_MARKS)
    return core if not core or (core[0].isalnum() and core[-1].isalnum()) else _EDGE.sub("", core)


def squeezed(word: str) -> str:
    """A word with runs of one letter as a single one."""
    return _RUN.sub(r"\1", word)


def suspicious(core: str) -> bool:
    """Whether a token without its outer marks hides letters: marks or digits among them, or a letter three times."""
    if _PLAIN.fullmatch(core):
        return _TRIPLE.search(core) is not None
    return sum(map(str.isalpha, core)) >= 2


def restore(token: str, model: CharacterModel, known: set[str] | frozenset = frozenset()) -> str:
    """A lower-cased token without its outer marks, deobfuscated if it looks like it.

    Marks at the ends may be letters in disguise (``$tupid``): such a token is decoded as a whole, and that reading
    wins if it is a ``known`` word and the bare core isn't.
    """
    core = bare(token)
    if known and len(core) < len(token) and core not in known and any(c in LEET for c in token):
        whole = viterbi(token, model)
        if whole in known:
            return whole
    return viterbi(core, model) if suspicious(core) else core


def pieces(token: str, model: CharacterModel) -> tuple[str, ...]:
    """The letters a lower-cased token may add to a split word: none for marks alone (``""``), itself if it is plain."""
    core = bare(token)
    if _PLAIN.fullmatch(core):
        return (core,)
    if len(token) <= PIECE and any(c in LEET or c.isalnum() for c in token):
        found = [""]
        for c in token:
            found = [f + x for f in found for x in ([c] if c.isalpha() else [*LEET.get(c, ""), *([] if c.isdigit() else [""])])]
        return tuple(dict.fromkeys(f for f in found if f))
    return (viterbi(core, model),) if suspicious(core) else () if core else ("",)


def features(word: str) -> list[str]:
    """What a restored word is scored by: itself, and its beginnings (marked ^)."""
    return [word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


@dataclass
class ToxicityModel:
    characters: CharacterModel
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = 0.0
    #: Added once if any scored feature is there.
    present: float = 0.0

    def __post_init__(self) -> None:
        self.memo: dict[str, tuple[tuple[int, ...], tuple[str, ...], bool]] = {}
        self.place = {w: i for i, w in enumerate(self.weights)}
        self.known = frozenset(w for w in self.weights if w[0] != "^")
        #: What a split word may begin with.
        self.heads = frozenset(w[:i] for w in self.known for i in range(1, len(w)))
        self.longest = max(map(len, self.known), default=0)

        #: First letters of what is scored, stretches of the known words, and these without doubled letters.
        self.stems = frozenset(w.lstrip("^")[:4] for w in self.weights)
        self.inner = frozenset(w[i:j] for w in self.known for i in range(len(w)) for j in range(i + 1, len(w) + 1))
        self.bent = frozenset(map(squeezed, self.inner))

    def _hits(self, word: str) -> tuple[int, ...]:
        return tuple(self.place[f] for f in features(word) if f in self.place) if word[:4] in self.stems else ()

    def _look(self, token: str) -> tuple[tuple[int, ...], tuple[str, ...], bool] | None:
        """A token's features, its readings as a piece of a split word, and whether it may begin one; None without any.

        Most tokens are plain words that have nothing to do with a known one, and a few set look-ups tell so.
        """
        core = bare(token)
        if core.isalpha() and not _TRIPLE.search(core):
            inner = core in self.inner
            if inner or core[:4] in self.stems or (len(core) < len(token) and squeezed(core) in self.bent):
                word = restore(token, self.characters, self.known)
                return self._hits(word), (core,) if inner else (), core in self.heads
            return None
        found = self.memo.get(token)
        if found is None:
            parts = pieces(token, self.characters) if len(token) <= 2 * self.longest else ()
            found = self.memo[token] = (self._hits(restore(token, self.characters, self.known)), parts, any(p in self.heads for p in parts))
        return found

    @staticmethod
    def _pieces_from(at: int, looked: dict, rows: np.ndarray, codes: np.ndarray, follows: np.ndarray) -> Iterator[tuple[str, ...]]:
        """The readings of the token at a place and of those after it in its text, as long as they may go on a word."""
        row = rows[at]
        while True:
            yield looked[codes[at]][1]
            at += 1
            if at == len(rows) or rows[at] != row or not follows[at]:
                return

    def _joined(self, parts: Iterator[tuple[str, ...]]) -> str | None:
        """The known word that the pieces from the first on spell, if it is likelier than the pieces."""
        heads, now = self.heads, {p: (p,) for p in next(parts) if p in self.heads}
        for options in parts:
            if options == ("",):
                continue
            new = {}
            for head, said in now.items():
                for p in options:
                    word = head + p
                    if word in self.known and spelling(word, self.characters) + DROP_BLANK * len(said) < sum(spelling(x, self.characters) for x in (*said, p)):
                        return word
                    if word in heads:
                        new[word] = (*said, p)
            now = new
            if not now:
                return None
        return None

    def score(self, body: pa.Array) -> np.ndarray:
        """By text, the probability of label 1."""
        rows, codes, words, _ = tokens(body)
        values = list(self.weights.values())
        if len(self.memo) > 100_000:
            self.memo.clear()
        looked = {i: found for i, w in enumerate(words) if (found := self._look(w))} if self.known else {}
        pairs: set[tuple[int, int]] = set()
        if looked:
            marks = np.zeros((3, len(words)), bool)
            for i, (hits, parts, head) in looked.items():
                marks[:, i] = bool(hits), head, bool(parts)
            seen, begins, follows = marks[:, codes]
            for row, code in zip(rows[seen].tolist(), codes[seen].tolist()):
                pairs.update((row, f) for f in looked[code][0])
            # split words: from every token that may begin one, over tokens that may go on
            for i in np.flatnonzero(begins[:-1] & follows[1:] & (rows[:-1] == rows[1:])).tolist():
                first, second = looked[codes[i]][1], looked[codes[i + 1]][1]
                if second == ("",) or any(p + q in self.heads or p + q in self.known for p in first for q in second):
                    word = self._joined(self._pieces_from(i, looked, rows, codes, follows))
                    if word:
                        pairs.update((int(rows[i]), f) for f in self._hits(word))
        total = np.full(len(body), self.intercept)
        for i in {i for i, _ in pairs}:
            total[i] += self.present
        for i, j in sorted(pairs):
            total[i] += values[j]
        return sigmoid(total)


def _features(text: bytes, model: CharacterModel, memo: dict[str, tuple[str, ...]], wanted: Collection[str] | None) -> set[str]:
    """A text's features, or those that are ``wanted``."""
    found: set[str] = set()
    for t in set(text.decode("utf-8", "replace").lower().split()):
        if t not in memo:
            memo[t] = tuple(f for f in features(restore(t, model)) if f and (wanted is None or f in wanted))
        found.update(memo[t])
    return found


def fit(sample: list[tuple[bytes, int]], prior: float | None = None, least: int = 5, characters: CharacterModel | None = None) -> ToxicityModel:
    """Word weights of a labelled sample; ``prior`` is the share of label 1 to calibrate to.

    ``characters`` is the character model of the whole corpus; without it, one of the sample's words is fitted.
    Words must be at least ``least`` times in texts of label 1 and pass a test of four standard errors.
    """
    texts = [(t, y) for t, y in sample]
    if characters is None:
        characters = fit_characters(Counter(w for t, _ in texts for w in t.decode("utf-8", "replace").lower().split() if plain(w)) or {"a": 1})
    ones = sum(y for _, y in texts)
    zeros = len(texts) - ones
    if not ones or not zeros:
        share = min(max(ones / len(texts) if texts else 1e-3, 1e-3), 1 - 1e-3)
        return ToxicityModel(characters, {}, math.log(share / (1 - share)))
    # texts of label 1 name the candidates; only these are counted, and kept by text, in the others
    in_one = Counter(f for t, y in texts if y for f in _features(t, characters, {}, None))
    in_one = Counter({w: n for w, n in in_one.items() if n >= least})
    names = sorted(in_one)
    number = {w: i for i, w in enumerate(names)}
    # texts as arrays of their candidates' numbers: as sets of words they would take a hundred times the memory
    memo: dict[str, tuple[str, ...]] = {}
    found = [(np.array(sorted(number[f] for f in _features(t, characters, memo, in_one.keys())), np.int32), y) for t, y in texts]
    memo.clear()
    zero = np.bincount(np.concatenate([x for x, y in found if not y] or [np.zeros(0, np.int32)]), minlength=len(names))
    strong = []
    for w, n in in_one.items():
        z0 = int(zero[number[w]])
        a, b = n / ones, z0 / zeros
        p = (n + z0) / len(texts)
        z = (a - b) / math.sqrt(p * (1 - p) * (1 / ones + 1 / zeros) + 1e-12)
        if z >= 4 and a > 4 * b:
            strong.append((z, w))
    chosen = [w for _, w in sorted(strong, key=lambda x: (-x[0], x[1]))]
    place = np.full(len(names), -1)
    place[[number[w] for w in chosen]] = np.arange(len(chosen))
    # most texts have none of the words: equal rows are one with a weight
    weight = Counter((tuple(sorted(place[x][place[x] >= 0].tolist())), y) for x, y in found)
    # columns: the words, whether any is there, and the intercept
    lists = [[*hits, *([len(chosen)] if hits else []), len(chosen) + 1] for hits, _ in weight]
    w = sparse_logistic(lists, len(chosen) + 2, np.array([y for _, y in weight], float), np.array(list(weight.values()), float), ridge=1.0)
    intercept = float(w[-1])
    if prior is not None and 0 < prior < 1:
        intercept += math.log(prior / (1 - prior)) - math.log(ones / zeros)
    return ToxicityModel(characters, dict(zip(chosen, w.tolist())), intercept, float(w[-2]))


def coded_trigrams(words: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of words as numbers (three code points of 21 bits), and how often each is there."""
    padded = [f"  {w} " for w in words]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.array([len(p) for p in padded], np.int64)
    within = np.ones(len(points), bool)
    ends = np.cumsum(sizes)
    within[ends - 1] = within[ends - 2] = False
    at = np.flatnonzero(within)
    codes = points[at] << 42 | points[at + 1] << 21 | points[at + 2]
    found, place = np.unique(codes, return_inverse=True)
    return found, np.bincount(place, weights=np.repeat(counts, sizes - 2)).astype(np.int64)


def count_trigrams(docs: DataFrame) -> dict[str, int]:
    """How often each trigram is in the plain words of all documents; counted by batch, then summed."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            _, codes, words, _ = tokens(batch.column(0))
            counts = np.bincount(codes, minlength=len(words))
            kept = [i for i, w in enumerate(words) if w.isalpha() and plain(w)]
            if kept:
                found, n = coded_trigrams([words[i] for i in kept], counts[kept])
                yield as_batch({"tri": found, "n": n})

    counted = checkpointed(text_bytes(docs).mapInArrow(run, "tri long, n long").groupBy("tri").agg(F.sum("n").alias("n")))
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("n") >= total * LEAST_SHARE).toArrow()
    text = lambda c: chr(c >> 42) + chr(c >> 21 & 0x1FFFFF) + chr(c & 0x1FFFFF)
    return {text(c): n for c, n in zip(found.column("tri").to_pylist(), found.column("n").to_pylist())}


def fit_tables(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5, held_out: int = 0, per_class: int = 2000, max_bytes: int = 16384) -> ToxicityModel:
    sample = labelled_sample(docs, labels, label, modulus, held_out, per_class, max_bytes)
    return fit(sample, characters=character_model(count_trigrams(docs) or trigrams({"a": 1})))


def score(docs: DataFrame, model: ToxicityModel, modulus: int = 5, held_out: int = 0, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            s = shared.value.score(batch.column(1))
            yield as_batch({"doc_id": batch.column(0), "score": s, "predicted": (s >= threshold).astype(np.int32)})
        shared.value.memo.clear()  # workers live on, and keep the model

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held_out, F.lit(False))
    return text_bytes(docs, "doc_id").mapInArrow(run, "doc_id long, score double, predicted int").select("doc_id", held.alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema, columns = docs.schema, docs.columns

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, "text"):
            body = batch.column(columns.index("text")).cast(pa.binary()).fill_null(b"")
            yield batch.filter(pa.array(shared.value.score(body) < threshold))
        shared.value.memo.clear()

    return docs.mapInArrow(run, schema)
