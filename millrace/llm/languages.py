"""Problem 8: the language of every text, and of each part of a mixed one.

The classifier averages hashed subword embeddings of a sentence and puts a linear softmax on the mean; both are trained
together by stochastic gradient descent in numpy on a bounded sample of labelled rows (SAMPLE per label). Labels may be
wrong: after a first round, sentences whose label the model plainly contradicts are left out of the second. A held-out
part of the sample calibrates the confidence (temperature) and the rejection threshold.

Every text is judged whole, sentence by sentence, code aside: its language is that of most of its words. A part is a
run of consecutive sentences of one language; two sentences or more make a passage.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.words import WORD

#: Labelled documents per label and sentences per document that the classifier is fitted on.
SAMPLE, SENTENCES = 150, 12
BUCKETS, DIMENSIONS, EPOCHS, RATE, BATCH = 1 << 15, 16, 8, 1.0, 64
#: Share of wrong answers that the accepted held-out sentences may have beyond the wrong labels among the surest ones.
SLACK = 0.01
#: A whole text is accepted at this part of the threshold of its sentences, as their mean is the safer number.
TEXT_SHARE = 0.6
#: Sentences that make a passage, and words (characters in scripts without blanks) a sentence needs to be judged.
PASSAGE, WORDS = 2, 4

# Languages by code, three-letter codes and English name.
LANGUAGES = {
    "en": ["eng", "english"], "ja": ["jpn", "japanese"], "de": ["deu", "ger", "german"], "fr": ["fra", "fre", "french"], "es": ["spa", "spanish", "castilian"], "pt": ["por", "portuguese"],
    "it": ["ita", "italian"], "nl": ["nld", "dut", "dutch", "flemish"], "zh": ["zho", "chi", "chinese", "mandarin"], "ru": ["rus", "russian"],
}

_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])")
_CODE = re.compile(
    r"^\s*(?:[$#>]\s?[\w./-]+\s+(?:run|install|--?\w)|(?:def|class|import|from|return|for|if|while|let|const|var|function|public|package)\b.*[(){};:=\]]|[{}\[\]()<>;,|]+\s*$|[\"'][\w-]+[\"']\s*:"
    r"|[\w.\[\]]+\s*[-+*/|&]?=\s*\S|[\w.]+\(.*\)\s*;?\s*$|<[^>]+>\s*$|```|~~~|\w+:\s*ok\b|[\w./-]+:\d+)"
)


def label_code(label: Column) -> Column:
    """The two-letter code that `label` names by code, region or English name; null where it names none of LANGUAGES."""
    text = F.lower(F.trim(F.regexp_extract(F.coalesce(label.cast("string"), F.lit("")), r"^\s*([A-Za-z]+)\s*(?:[-_ (].*)?$", 1)))
    names = {name: code for code, others in LANGUAGES.items() for name in (code, *others)}
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), text)


def sentences(text: str) -> list[list[str]]:
    """The words of every sentence of `text` that has enough of them; code and links are left out."""
    out, fenced = [], False
    for line in text.split("\n"):
        if "``" in line or "~~~" in line:
            if line.lstrip()[:3] in ("```", "~~~"):
                fenced = not fenced
                continue
        if fenced or not line or _CODE.match(line):
            continue
        for sentence in _SENTENCE.split(line):
            if "://" in sentence:
                sentence = re.sub(r"\S+://\S+", " ", sentence)
            words = [w for w in WORD.findall(sentence.lower()) if not w.isdigit()]
            if len(words) >= WORDS:
                out.append(words)
    return out


def subwords(word: str) -> np.ndarray:
    """Buckets of the word and its pieces of two to four characters, its ends marked."""
    marked = f"<{word}>"
    pieces = [marked] + [marked[i : i + n] for n in (2, 3, 4) for i in range(len(marked) - n + 1)]
    return np.array([xxhash.xxh3_64_intdigest(p.encode()) % BUCKETS for p in pieces], np.int64)


class Classifier:
    """Averaged embeddings and a linear softmax, folded into one table of class scores per bucket for use."""

    def __init__(self, codes: list[str], embeddings: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.codes, self.table, self.bias = codes, (embeddings @ weights).astype(np.float32), bias.astype(np.float32)
        self.temperature, self.threshold = 1.0, 0.0
        self._ready()

    def _ready(self) -> None:
        self.memo: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.codes)), np.float32)
        self.counts = np.zeros(1024, np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "scores", "counts")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _word(self, word: str) -> int:
        at = self.memo[word] = len(self.memo)
        if at == len(self.counts):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        buckets = subwords(word)
        self.scores[at], self.counts[at] = self.table[buckets].sum(axis=0), len(buckets)
        return at

    def logits(self, texts: list[list[str]]) -> np.ndarray:
        """A row of class scores for each list of words (none empty)."""
        if not texts:
            return np.zeros((0, len(self.codes)), np.float32)
        if len(self.memo) > 200_000:
            self._ready()
        memo, word = self.memo, self._word
        places = np.array([memo[w] if w in memo else word(w) for t in texts for w in t], np.int64)
        starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])[:-1]))
        sums, counts = np.add.reduceat(self.scores[places], starts), np.add.reduceat(self.counts[places], starts)
        return sums / counts[:, None] + self.bias

    def confidence(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train(texts: list[list[str]], labels: np.ndarray, codes: list[str], seed: int = 7) -> Classifier:
    """Embeddings and softmax by stochastic gradient descent over minibatches of sentences."""
    rng = np.random.default_rng(seed)
    memo: dict[str, np.ndarray] = {}
    features = [np.concatenate([memo[w] if w in memo else memo.setdefault(w, subwords(w)) for w in t]) for t in texts]
    embeddings, weights, bias = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)), rng.normal(0, 0.3, (DIMENSIONS, len(codes))), np.zeros(len(codes))
    steps = max(1, EPOCHS * -(-len(texts) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            flat = np.concatenate([features[i] for i in batch])
            sizes = np.array([len(features[i]) for i in batch])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            mean = np.add.reduceat(embeddings[flat], starts) / sizes[:, None]
            z = mean @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            back = p @ weights.T / sizes[:, None]
            weights -= rate * mean.T @ p / len(batch) * 10
            bias -= rate * p.mean(axis=0)
            np.add.at(embeddings, flat, np.repeat(-rate * back, sizes, axis=0))
    return Classifier(codes, embeddings, weights, bias)


def calibrate(model: Classifier, texts: list[list[str]], labels: np.ndarray) -> None:
    """Temperature by least log-loss and the rejection threshold by SLACK, both on held-out sentences.

    Held-out labels are wrong as often as others. What the surest half of the answers contradicts is taken for that share;
    the threshold is the least confidence down to which the accepted answers contradict hardly more.
    """
    logits = model.logits(texts)
    losses = []
    grid = np.geomspace(0.1, 10, 41)
    for t in grid:
        model.temperature = float(t)
        losses.append(-np.log(model.confidence(logits)[np.arange(len(labels)), labels] + 1e-12).mean())
    model.temperature = float(grid[int(np.argmin(losses))])
    confidence = model.confidence(logits)
    best, right = confidence.max(axis=1), confidence.argmax(axis=1) == labels
    order = np.argsort(-best)
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(wrong <= wrong[(len(order) - 1) // 2] + SLACK)
    model.threshold = float(best[order][good[-1]])


def _openings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the first SENTENCES sentences of each text."""
    for batch in batches:
        found = pa.array([sentences(t)[:SENTENCES] for t in batch.column(2).to_pylist()], pa.list_(pa.list_(pa.string())))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), found], names=["key", "code", "sentences"])


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Classifier | None:
    """The classifier of a bounded sample of labelled documents: SAMPLE of each label, by the hash of their keys.

    None if fewer than two languages are named. Of the sample (at most SAMPLE documents of each language) the words of the
    first SENTENCES sentences each come to the driver; nothing else does. Every fifth document is held out: neither round
    of training sees it.
    """
    coded = docs.select(F.col(key).alias("key"), label_code(F.col(label)).alias("code"), F.col(text).cast("string").alias("text")).where("code is not null and length(text) > 20")
    rank = F.row_number().over(Window.partitionBy("code").orderBy(F.xxhash64("key"), "key"))
    keys = coded.select("key", "code").withColumn("rank", rank).where(F.col("rank") <= SAMPLE).select("key", "code")
    sampled = coded.join(F.broadcast(keys), ["key", "code"]).select("key", "code", "text")
    kind = sampled.schema["key"].dataType.simpleString()
    rows = sorted(sampled.mapInArrow(_openings, f"key {kind}, code string, sentences array<array<string>>").collect(), key=lambda r: (r.code, r.key, r.sentences))
    codes = sorted({r.code for r in rows})
    if len(codes) < 2:
        return None
    texts, labels, held = [], [], []
    for n, r in enumerate(rows):
        for words in r.sentences:
            texts.append(words)
            labels.append(codes.index(r.code))
            held.append(n % 5 == 0)
    labels, held = np.array(labels), np.array(held)
    if len(texts) < 10:
        return None
    seen = np.flatnonzero(~held)
    if not len(seen) or not held.any():
        seen, held = np.arange(len(texts)), np.zeros(len(texts), bool)
    first = train([texts[i] for i in seen], labels[seen], codes)
    p = first.confidence(first.logits(texts))
    plain = p[np.arange(len(labels)), labels] >= 0.3 * p.max(axis=1)
    kept = np.flatnonzero(plain & ~held)
    model = train([texts[i] for i in kept], labels[kept], codes)
    check = np.flatnonzero(plain & held)
    if len(check):
        calibrate(model, [texts[i] for i in check], labels[check])
    return model


def judge(model: Classifier, texts: list[str | None]) -> list[tuple[str | None, float, list[tuple]]]:
    """(language, confidence, parts) of each text; parts: accepted runs as (language, first, last, sentences, confidence)."""
    parsed = [sentences(t) if t else [] for t in texts]
    logits = model.logits([s for p in parsed for s in p])
    confidence = model.confidence(logits)
    best, sure = confidence.argmax(axis=1), confidence.max(axis=1)
    out, at = [], 0
    for p in parsed:
        n = len(p)
        if not n:
            out.append((None, 0.0, []))
            continue
        langs, probs = best[at : at + n].tolist(), sure[at : at + n].tolist()
        weights = np.array([len(s) for s in p], float)
        total = weights @ confidence[at : at + n] / weights.sum()
        at += n
        parts: list[list] = []
        for k, (lang, prob) in enumerate(zip(langs, probs)):
            if prob < model.threshold:
                continue  # rejected: it neither makes nor breaks a run
            if parts and parts[-1][0] == lang:
                parts[-1][2:] = [k, parts[-1][3] + [prob]]
            else:
                parts.append([lang, k, k, [prob]])
        top = int(total.argmax())
        accepted = total[top] >= TEXT_SHARE * model.threshold
        out.append((model.codes[top] if accepted else None, float(total[top]), [(model.codes[g], a, b, len(c), float(np.mean(c))) for g, a, b, c in parts]))
    return out


SCHEMA = "language string, confidence double, parts array<struct<lang:string,first:int,last:int,sentences:int,confidence:double>>"


def text_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", model: Classifier | None = None) -> DataFrame:
    """(key, label_code, language, confidence, parts) of every row of `docs`.

    `language` is null for null, empty and wordless texts and where every sentence is rejected; `parts` are the runs of
    consecutive sentences of one language, with the confidence of each. Repeated rows stay; other columns are ignored; an
    empty table, or one whose labels name fewer than two languages, gives null languages.
    """
    model = fit(docs, key, text, label) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS times the number of languages
    rows = docs.select(F.col(key).alias("key"), label_code(F.col(label)).alias("label_code"), F.col(text).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = judge(shared.value, texts) if shared.value else [(None, 0.0, [])] * len(texts)
            parts = [[dict(zip(("lang", "first", "last", "sentences", "confidence"), part)) for part in p] for _, _, p in found]
            kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("sentences", pa.int32()), ("confidence", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array(parts, kind)],
                names=[key, "label_code", "language", "confidence", "parts"],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(work, f"`{key}` {kind}, label_code string, {SCHEMA}")


def languages_found(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", model: Classifier | None = None) -> DataFrame:
    """(key, lang): texts whose label is missing, names no language or another one, with their language; and texts with
    passages in several languages, one row per language whatever the label. See `text_languages` for odd inputs."""
    judged = text_languages(docs, key, text, label, model).where("language is not null")
    passages = F.array_distinct(F.transform(F.filter("parts", lambda p: p["sentences"] >= PASSAGE), lambda p: p["lang"]))
    langs = F.when(F.size(passages) > 1, passages).when(~F.col("label_code").eqNullSafe(F.col("language")), F.array("language"))
    return judged.select(key, F.explode(langs).alias("lang"))
