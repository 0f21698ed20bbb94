"""Language of texts and of the stretches inside them (problem 8).

One interpolated Kneser-Ney model of characters per language. The models are kept together
in sorted hash arrays: per order, the sorted hashes of all n-grams seen in any language,
with the interpolated log-probability under every language, and the sorted hashes of all
contexts with their back-off weights. A position is looked up from the longest order down;
each miss adds the back-off weight of its context, so most positions need one binary search.

A text is cut into sentences; each goes to the language of lowest cross-entropy per
character. It is rejected ("und") if that entropy is above the language's limit, or if the
piece is no sentence: too few words or letters (headings, tables, formulae, single phrases).
The limit lies between what held-out sentences of the language score and what sentences of
the other languages score under it when their own model is left out, which stand for
languages without a model. The confidence is the posterior over the languages; its
temperature is fitted on the labels of all held-out sentences, wrong ones included.

Training uses the labelled rows themselves: a bounded sample (``SAMPLE_ROWS`` distinct texts per
language, drawn by hash of text, of each at most ``SAMPLE_CHARS`` characters from a place that
the hash gives), so copies of a text, however many, are one row. Labels may be
wrong, so sentences are re-labelled by the models and the models refitted ``ROUNDS`` times.
Everything else - scoring, decisions - covers every row and whole texts.

Results: null, empty and blank texts, and texts without a sentence, have no row in
``segments`` and language "und" with confidence 0 in ``documents``. Labels name a language
if they are its code, alone or with a region. If no row is labelled, nothing is recognised.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The languages that are told apart.
LANGUAGES = ("en", "de", "fr", "es", "pt", "it", "ru", "zh")
ORDER = 5
SAMPLE_ROWS = 250
SAMPLE_CHARS = 20_000
ROUNDS = 2
#: The limit of rejection: so far from this quantile of the language's own held-out entropies
#: to the low quantile of the other languages' entropies.
OWN_QUANTILE, OTHER_QUANTILE, REJECT_SHARE = 0.995, 0.005, 0.7
MIN_WORDS, MIN_LETTERS, MIN_HAN = 4, 16, 6
#: Positions scored at once.
CHUNK = 400_000
#: Probability of a character that no training text has, if the language writes in its script or not.
UNSEEN = (np.log(1e-7), np.log(1e-4))

# ---- text -------------------------------------------------------------------------------

_BROKEN = re.compile("[ÂÃÄÅÐÑØÙàáâãäåæçèéï][\u0080-¿€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]{1,3}")
_TAG = re.compile(r"<[^<>]{1,200}>|(?:https?://|www\.)\S+|\S+@\S+\.\w+")  # tags and addresses are no words
_HYPHEN = re.compile(r"(?<=\w)[-­‐]\s*\r?\n\s*(?=\w)")
_END = re.compile(r"(?<=[.!?])[\"'”’»)\]]*\s+|(?<=[。！？])|\s*\n\s*\n\s*|\n(?![a-zà-öø-ÿа-я])")
_NOT_LETTER = re.compile(r"[\W\d_]+")
_HAN = re.compile("[㐀-鿿]")


def _unbreak(m: re.Match) -> str:
    raw = bytearray()
    for ch in m[0]:
        try:
            raw += ch.encode("cp1252")
        except UnicodeEncodeError:
            if ord(ch) > 255:
                return m[0]
            raw.append(ord(ch))
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


def letters_of(piece: str) -> str | None:
    """The letters of a piece in lower case, words apart; None if it can be no sentence."""
    letters = _NOT_LETTER.sub(" ", piece.lower()).strip()
    if not letters:
        return None
    words, han = letters.count(" ") + 1, len(_HAN.findall(letters))
    solid = len(letters) - words + 1
    if solid * 2 < len(piece) - piece.count(" ") and han < MIN_HAN:
        return None  # mostly signs and digits
    return letters if han >= MIN_HAN or (words >= MIN_WORDS and solid >= MIN_LETTERS and words * 20 > solid) else None


def sentences(text: str | None, known: dict[str, str | None] | None = None) -> list[tuple[int, str]]:
    """(length in characters, letters) of every piece that may be a sentence; ``known`` keeps the
    letters of pieces that come again."""
    if not text or not text.strip():
        return []
    known = {} if known is None else known
    t = _BROKEN.sub(_unbreak, text)
    t = _HYPHEN.sub("", _TAG.sub(" ", unicodedata.normalize("NFKC", t))).replace("­", "")
    out = []
    for piece in _END.split(t):
        if piece not in known:
            known[piece] = letters_of(piece)
        if known[piece]:
            out.append((len(piece), known[piece]))
    return out


# ---- models -----------------------------------------------------------------------------


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the padded texts end to end, and the text of each."""
    joined = "".join(f" {t} " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    return codes, np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])


def _grams(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k characters that end at each position k-1, k, ..."""
    n = len(codes) - k + 1
    h = np.zeros(max(n, 0), np.uint64)
    for i in range(k):
        h = (h ^ codes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def _script(codes: np.ndarray) -> np.ndarray:
    """0 Latin, 1 Cyrillic, 2 Han, 3 any other character."""
    c = codes.astype(np.int64)
    return np.select([(c > 0x40) & (c < 0x250), (c >= 0x400) & (c < 0x530), (c >= 0x3400) & (c < 0xA000)], [0, 1, 2], 3)


def _find(keys: np.ndarray, what: np.ndarray) -> np.ndarray:
    """Index of each hash in the sorted ``keys``, -1 if absent."""
    if not len(keys):
        return np.full(len(what), -1)
    at = np.minimum(np.searchsorted(keys, what), len(keys) - 1)
    return np.where(keys[at] == what, at, -1)


class Models:
    """All languages' models in sorted hash arrays."""

    def __init__(self, by_language: list[list[str]], order: int = ORDER):
        self.order, n = order, len(by_language)
        data = []
        for texts in by_language:
            codes, doc = _codes(texts)
            data.append([(h := _grams(codes, k), doc[k - 1 :] == doc[: len(h)]) for k in range(1, order + 1)])
        self.keys: list[np.ndarray] = []
        self.logp: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = [np.zeros(0, np.uint64)]
        self.back: list[np.ndarray] = [np.zeros((0, n), np.float32)]
        below = None  # probabilities one order down
        for k in range(1, order + 1):
            grams, counts, prefix, suffix = [], [], [], []
            for per in data:
                h, ok = per[k - 1]
                if k < order:  # continuation count: distinct characters to the left
                    up, upok = per[k]
                    pairs, first = np.unique(up[upok], return_index=True)
                    where = np.flatnonzero(upok)[first]  # start of the longer gram
                    g, c = np.unique(h[where + 1], return_counts=True)
                    raw, at = np.unique(h[ok], return_index=True)
                    at = np.flatnonzero(ok)[at]
                    full = np.zeros(len(raw), np.int64)
                    full[np.searchsorted(raw, g)] = c  # grams that only open a text have count 0
                    g, c = raw, np.maximum(full, 1)
                else:
                    g, at, c = np.unique(h[ok], return_index=True, return_counts=True)
                    at = np.flatnonzero(ok)[at]
                grams.append(g)
                counts.append(c)
                prefix.append(per[k - 2][0][at] if k > 1 else np.zeros(len(g), np.uint64))
                suffix.append(per[k - 2][0][at + 1] if k > 1 else np.zeros(len(g), np.uint64))
            keys, pos = np.unique(np.concatenate(grams), return_index=True)
            pre, suf = np.concatenate(prefix)[pos], np.concatenate(suffix)[pos]
            ctx = np.unique(pre)
            p = np.zeros((len(keys), n))
            gamma = np.ones((len(ctx), n))
            for i, (g, c) in enumerate(zip(grams, counts)):
                if not len(g):
                    continue
                n1, n2 = (c == 1).sum(), (c == 2).sum()
                d = min(max(n1 / max(n1 + 2 * n2, 1), 0.1), 0.9)
                own = np.searchsorted(ctx, prefix[i])
                total = np.bincount(own, weights=c, minlength=len(ctx))
                kinds = np.bincount(own, minlength=len(ctx))
                seen = total > 0
                gamma[seen, i] = d * kinds[seen] / total[seen]
                p[np.searchsorted(keys, g), i] = (c - d) / total[own]
            lower = np.full((len(keys), n), 1 / (len(keys) + 1)) if k == 1 else below[np.searchsorted(self.keys[-1], suf)]
            p += gamma[np.searchsorted(ctx, pre)] * lower
            below = np.maximum(p, 1e-9)
            self.keys.append(keys)
            self.logp.append(np.log(below).astype(np.float32))
            if k > 1:
                self.contexts.append(ctx)
                self.back.append(np.log(np.maximum(gamma, 1e-9)).astype(np.float32))
        own = [np.bincount(_script(_codes(texts)[0]), minlength=4)[:3] for texts in by_language]
        share = np.array([c / max(c.sum(), 1) for c in own])  # languages x scripts
        self.unseen = np.vstack([np.where(share.T > 0.2, UNSEEN[1], UNSEEN[0]), np.full(n, UNSEEN[0])]).astype(np.float32)
        self.absent = np.array([not texts for texts in by_language])
        self.limit = np.full(n, np.inf)
        self.alpha = 10.0

    def entropy(self, texts: list[str]) -> np.ndarray:
        """Nats per character of each text under each language, shape (texts, languages)."""
        out = np.zeros((len(texts), self.logp[0].shape[1]))
        start, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t) + 2
            if size >= CHUNK or i == len(texts) - 1:
                out[start : i + 1] = self._entropy(texts[start : i + 1])
                start, size = i + 1, 0
        return out

    def _entropy(self, texts: list[str]) -> np.ndarray:
        codes, doc = _codes(texts)
        n = len(codes)
        score = np.zeros((n, self.logp[0].shape[1]), np.float32)
        first = np.searchsorted(doc, np.arange(len(texts)))
        room = np.arange(n) - first[doc] + 1  # characters of the text up to here
        open_ = np.arange(n)
        for k in range(self.order, 0, -1):
            h = _grams(codes, k)
            fits = room[open_] >= k
            at = np.full(len(open_), -1)
            if len(h):
                at[fits] = _find(self.keys[k - 1], h[open_[fits] - k + 1])
            hit = at >= 0
            score[open_[hit]] += self.logp[k - 1][at[hit]]
            if k > 1:
                miss = ~hit & fits
                rows = open_[miss]
                c = _find(self.contexts[k - 1], _grams(codes, k - 1)[rows - k + 1])
                score[rows[c >= 0]] += self.back[k - 1][c[c >= 0]]
            open_ = open_[~hit]
        score[open_] += self.unseen[_script(codes[open_])]
        lengths = np.bincount(doc, minlength=len(texts))
        out = -np.add.reduceat(score, first, axis=0) / lengths[:, None]
        out[:, self.absent] = 1e3  # never chosen
        return out

    def decide(self, texts: list[str]) -> list[tuple[int, float]]:
        """(language number or -1, confidence) of each text; equal texts are scored once."""
        if not texts:
            return []
        place: dict[str, int] = {}
        at = [place.setdefault(t, len(place)) for t in texts]
        e = self.entropy(list(place))
        best = e.argmin(1)
        z = np.exp(-self.alpha * (e - e.min(1, keepdims=True)))
        conf = (1 / z.sum(1)).tolist()
        lang = np.where(e.min(1) <= self.limit[best], best, -1).tolist()
        return [(lang[i], conf[i]) for i in at]

    def calibrate(self, e: np.ndarray, labels: list[np.ndarray]) -> None:
        """Limits and temperature from the entropies of held-out sentences; ``labels`` has the
        labels under which each of them occurs."""
        y, low = e.argmin(1), e.min(1)
        others = e.copy()
        others[np.arange(len(e)), y] = np.inf
        second = others.argmin(1)  # what each would be without its own model
        for i in range(e.shape[1]):
            own, other = low[y == i], others[second == i, i]
            other = other[other < 1e3]
            top = np.quantile(own if len(own) >= 5 else low, OWN_QUANTILE)  # with few of its own, of all
            floor = np.quantile(other, OTHER_QUANTILE) if len(other) >= 5 else 4 * top
            self.limit[i] = top + REJECT_SHARE * max(floor - top, 0)
        row = np.repeat(np.arange(len(e)), [len(x) for x in labels])
        lab = np.concatenate(labels) if labels else np.zeros(0, int)
        wrong = np.clip((lab != y[row]).mean() if len(lab) else 0, 1e-3, 0.5)

        def fit_of(a: float) -> float:
            z = np.exp(-a * (e - low[:, None]))
            p = z / z.sum(1, keepdims=True)
            return float(np.log((1 - wrong) * p[row, lab] + wrong / e.shape[1]).mean())

        self.alpha = max((0.5, 1.0, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0), key=fit_of)


def fit(rows: list[tuple[str, int]], order: int = ORDER, rounds: int = ROUNDS) -> Models | None:
    """Models from (text, language number) rows whose labels may be wrong."""
    known = [(s, y) for text, y in rows for _, s in sentences(text)]
    known.sort()  # repeats stay: a sentence counts under each label as often as it has it
    held = {s for s, _ in known if _fold(s)}
    train = [(s, y) for s, y in known if s not in held]
    if not train:
        return None
    split = lambda pairs: [[s for s, y in pairs if y == i] for i in range(len(LANGUAGES))]
    # A model is conditional, so a language mixed into another's texts would cost it nothing.
    # The first labels therefore go by the plain frequency of n-grams, which the mixture lowers.
    texts = [s for s, _ in train]
    train = list(zip(texts, _by_frequency(texts, np.array([y for _, y in train])).tolist()))
    models = Models(split(train), order)
    for _ in range(rounds):
        texts = [s for s, _ in train]
        train = list(zip(texts, models.entropy(texts).argmin(1).tolist()))
        models = Models(split(train), order)
    texts = sorted(held)
    if texts:
        e = models.entropy(texts)
        given: dict[str, list[int]] = {}
        for t, lab in known:
            given.setdefault(t, []).append(lab)
        models.calibrate(e, [np.array(given[t]) for t in texts])
        final = Models(split(train + list(zip(texts, e.argmin(1).tolist()))), order)  # nothing held out any more
        final.limit, final.alpha = models.limit, models.alpha
        return final
    return models


def _by_frequency(texts: list[str], labels: np.ndarray, k: int = 4) -> np.ndarray:
    """Label of each text under which its k-grams are most frequent."""
    codes, doc = _codes(texts)
    h = _grams(codes, k)
    ok = doc[k - 1 :] == doc[: len(h)]
    keys, gram = np.unique(h[ok], return_inverse=True)
    at = doc[k - 1 :][ok]
    n = len(LANGUAGES)
    counts = np.bincount(gram * n + labels[at], minlength=len(keys) * n).reshape(-1, n)
    total = counts.sum(0)
    logp = np.log((counts + 0.01) / np.maximum(total, 1))
    logp[:, total == 0] = -1e3  # a language without a text is none's
    score = np.zeros((len(texts), n))
    np.add.at(score, at, logp[gram])
    return score.argmax(1)


def _fold(s: str) -> bool:
    """A fixed tenth of the sentences is held out."""
    import zlib

    return zlib.crc32(s.encode()) % 10 == 0


# ---- plans ------------------------------------------------------------------------------


def labelled(label: Column) -> Column:
    """The language that a label names, or null."""
    return F.lower(F.nullif(F.regexp_extract(label, rf"^(?i)({'|'.join(LANGUAGES)})(?:[-_][A-Za-z0-9]+)?$", 1), F.lit("")))


def train(docs: DataFrame, text: str = "text", label: str = "lang") -> Models | None:
    """Models from a bounded sample of the labelled rows."""
    got = docs.select(F.col(text).alias("text"), labelled(F.col(label)).alias("y"), F.xxhash64(text).alias("h")).where("y is not null and text is not null")
    pick = Window.partitionBy("y").orderBy("h")
    few = got.select("y", "h").distinct().withColumn("n", F.row_number().over(pick)).where(F.col("n") <= SAMPLE_ROWS).drop("n")  # at most 8 x SAMPLE_ROWS rows
    begin = F.expr(f"cast(1 + pmod(h, greatest(1, length(text) - {SAMPLE_CHARS} + 1)) as int)")
    part = F.substr("text", begin, F.lit(SAMPLE_CHARS))
    rows = got.join(F.broadcast(few), ["y", "h"]).groupBy("y", "h").agg(F.min(part).alias("text")).orderBy("y", "h").collect()
    return fit([(r["text"], LANGUAGES.index(r["y"])) for r in rows])


SEGMENT = "segment_no int, lang string, confidence double, n_sentences int, n_chars int"


def segments(docs: DataFrame, key: str = "doc_id", text: str = "text", models: Models | None = None) -> DataFrame:
    """(key, segment_no, lang, confidence, n_sentences, n_chars): stretches of one language.

    Confidence is the mean over the sentences, weighted by length. Rejected sentences
    interrupt no stretch.
    """
    models = models or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    kind = docs.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in frames:
            rows, pieces, owner = [], [], []
            known: dict[str, str | None] = {}
            for i, t in enumerate(f["text"]):
                for n, s in sentences(t, known):
                    pieces.append((n, s))
                    owner.append(i)
            found = m.decide([s for _, s in pieces]) if m else []
            keys = f["key"].tolist()
            last, run_ = None, None
            for i, (n, _), (y, c) in zip(owner, pieces, found):
                if y < 0:
                    continue
                if last != (i, y):
                    run_ = [keys[i], run_[1] + 1 if last and last[0] == i else 0, LANGUAGES[y], 0.0, 0, 0]
                    rows.append(run_)
                    last = (i, y)
                run_[3] += c * n
                run_[4] += 1
                run_[5] += n
            for r in rows:
                r[3] = round(r[3] / r[5], 6)
            yield pd.DataFrame(rows, columns=["key", "segment_no", "lang", "confidence", "n_sentences", "n_chars"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, f"key {kind}, {SEGMENT}").withColumnRenamed("key", key)


def unnamed(segs: DataFrame, docs: DataFrame, key: str = "doc_id", label: str = "lang") -> DataFrame:
    """(key, lang): languages that have a sentence in the text and that its label does not name."""
    named = docs.select(key, labelled(F.col(label)).alias("y"))
    got = segs.select(key, "lang").distinct().join(named, key)
    return got.where(F.col("y").isNull() | (F.col("y") != F.col("lang"))).select(key, "lang")


def documents(segs: DataFrame, docs: DataFrame, key: str = "doc_id", label: str = "lang") -> DataFrame:
    """(key, label, lang, confidence, share, n_languages): one row per text.

    The language of most characters wins, ties by code; "und" with confidence 0 for none.
    """
    per = segs.groupBy(key, "lang").agg(F.sum("n_chars").alias("n"), F.sum(F.col("confidence") * F.col("n_chars")).alias("w"))
    top = per.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("m"), "lang", "w")).alias("t"), F.sum("n").alias("all"), F.count(F.lit(1)).cast("int").alias("n_languages"))
    got = docs.select(key, F.col(label).alias("label")).join(top, key, "left")
    return got.select(
        key, "label", F.coalesce("t.lang", F.lit("und")).alias("lang"), F.round(F.coalesce(-F.col("t.w") / F.col("t.m"), F.lit(0.0)), 6).alias("confidence"),
        F.round(F.coalesce(-F.col("t.m") / F.col("all"), F.lit(0.0)), 6).alias("share"), F.coalesce("n_languages", F.lit(0)).alias("n_languages"),
    )
