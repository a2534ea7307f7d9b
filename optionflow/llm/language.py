"""Language identification of texts that may mix languages.

A word is scored per language by the log probabilities of its letter 1- to 3-grams. The
script of a word narrows the languages down to those that were seen in it. A Viterbi pass over
a text's words, with a penalty for each switch, labels stretches of one language;
the text's language is the one that most of its words with letters got.

The gram statistics come from a sample of at most about `SAMPLE` texts per language, counted
in Spark; the model has at most `GRAMS` grams per language, whatever the corpus size.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from .ranks import unit
from .texts import Numbered, portions, thrifty

#: Texts per language to learn from (on average, by hash); grams kept per language.
SAMPLE, GRAMS = 2000, 20_000

#: Cost of a switch of language, and the most that one word can speak against a language, in nats.
SWITCH, MOST = 12.0, 8.0

NONE = "und"

#: Bits of a letter in a gram's code. Bytes of words whose scores a task remembers, and what a word takes beside its letters.
BITS, REMEMBERED, WORD_BYTES = 21, 48_000_000, 160

# First code points of script ranges in Unicode, and the script from there on.
RANGES = (
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Indic"),
    (0x0E00, "Thai"),
    (0x0E80, "Lao"),
    (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x1380, "other"),
    (0x1780, "Khmer"),
    (0x1800, "other"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "other"),
    (0x2C60, "Latin"),
    (0x2C80, "other"),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0xA000, "other"),
    (0xA720, "Latin"),
    (0xA800, "other"),
    (0xAC00, "Hangul"),
    (0xD7B0, "other"),
    (0xF900, "Han"),
    (0xFB50, "Arabic"),
    (0xFF21, "Latin"),
    (0xFF66, "Kana"),
    (0x20000, "Han"),
)
STARTS = [a for a, _ in RANGES]

#: A language is a candidate for a script that holds at least this share of its words.
SCRIPT_SHARE = 0.01

LETTERS = regex.compile(r"\p{L}+")


def script(letter: str) -> str:
    return RANGES[bisect_right(STARTS, ord(letter)) - 1][1]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    grams: np.ndarray  # sorted codes of the grams: 21 bits per letter
    scores: np.ndarray  # log probability per gram and language
    unseen: np.ndarray  # log probability of any other gram, per language
    scripts: dict[str, np.ndarray]  # which languages use a script


def framed(word: Column) -> Column:
    return F.concat(F.lit("_"), word, F.lit("_"))


def fit(docs: DataFrame, learn: Column, id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from rows where `learn` is true and both text and language are given.

    Only the number of rows per language and grams of the sample reach the driver; both are
    bounded by the number of languages.
    """
    known = docs.filter(learn & F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = {r[lang]: r["count"] for r in known.groupBy(lang).count().collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return Model((), np.empty(0, np.int64), np.zeros((0, 0)), np.zeros(0), {})
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample / n))])
    taken = known.filter(unit(F.col(id), F.lit("sample")) < shares[F.col(lang)])
    letters = F.split(F.lower(F.col(text)), r"[^\p{L}]+")
    words = taken.select(F.col(lang).alias("lang"), F.explode(letters).alias("word")).filter("word <> ''")
    words = words.groupBy("lang", "word").agg(F.count("*").alias("n"))
    first = words.groupBy("lang", F.substring("word", 1, 1).alias("letter")).agg(F.sum("n").alias("n"))

    whole = framed(F.col("word"))
    size = F.length("word")
    pieces = F.concat(
        F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(F.col("word"), i, F.lit(1))),
        F.transform(F.sequence(F.lit(1), size + 1), lambda i: F.substring(whole, i, F.lit(2))),
        F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(whole, i, F.lit(3))),
    )
    grams = words.select("lang", "n", F.explode(pieces).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = grams.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    total = F.sum("n").over(W.partitionBy("lang", F.length("gram")))
    rows = top.withColumn("total", total).filter(F.col("place") <= GRAMS).collect()

    index = {g: i for i, g in enumerate(sorted({r["gram"] for r in rows}, key=code))}
    column = {l: j for j, l in enumerate(languages)}
    totals = np.ones((4, len(languages)))
    for r in rows:
        totals[len(r["gram"]), column[r["lang"]]] = r["total"]
    floor = -np.log(totals + len(index))
    scores = np.zeros((len(index), len(languages)))
    for g, i in index.items():
        scores[i] = floor[len(g)]
    for r in rows:
        j = column[r["lang"]]
        scores[index[r["gram"]], j] = np.log(r["n"] + 1) + floor[len(r["gram"]), j]

    used = {}
    for r in first.collect():
        row = used.setdefault(script(r["letter"]), np.zeros(len(languages)))
        row[column[r["lang"]]] += r["n"]
    shown = sum(used.values())
    scripts = {s: row >= SCRIPT_SHARE * np.maximum(shown, 1) for s, row in used.items()}
    grams = np.array([code(g) for g in index], np.int64)
    return Model(languages, grams, scores, floor.mean(0), scripts)


def code(gram: str) -> int:
    """One number per gram of up to three letters."""
    value = 0
    for letter in gram:
        value = value << BITS | ord(letter)
    return value


def word_scores(model: Model, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row per word: how much less each language explains it than the best one does, 0 to -MOST; how many letters it has, and
    of how many of them the 3-gram around is known.

    Words without letters have zeros.
    """
    runs = [LETTERS.findall(w) for w in words]
    counts = np.array([len(r) for r in runs], np.int64)
    lettered, totals = counts > 0, np.zeros((len(words), len(model.languages)))
    if not lettered.any():
        return totals, counts, counts
    flat = list(chain.from_iterable(runs))
    # each run and a line behind it, after one line; `word` is the word of each place
    letters = np.frombuffer(f"_{'_'.join(flat)}_".encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.array([len(r) + 1 for r in flat], np.int64)
    word = np.concatenate([[0], np.repeat(np.repeat(np.arange(len(words)), counts), sizes)])
    middle = np.flatnonzero(letters != ord("_"))
    before, after = letters[middle - 1], letters[middle + 1]
    first = middle[before == ord("_")]
    ones = letters[middle]
    grams = np.concatenate(
        [
            ones,
            ones << BITS | after,
            ord("_") << BITS | letters[first],
            before << 2 * BITS | ones << BITS | after,
        ]
    )
    owner = np.concatenate([word[middle], word[middle], word[first], word[middle]])
    at = np.minimum(np.searchsorted(model.grams, grams), len(model.grams) - 1)
    known = model.grams[at] == grams
    size = np.bincount(word[middle], minlength=len(words))
    seen = np.bincount(word[middle][known[-len(middle) :]], minlength=len(words))
    for j in range(len(model.languages)):
        # 1-, 2- and 3-grams say the same thing three times
        value = np.where(known, model.scores[at, j], model.unseen[j]) / 3
        totals[:, j] = np.bincount(owner, weights=value, minlength=len(words))
    start = np.cumsum(counts) - counts
    initial = [flat[i][0] if c else "" for i, c in zip(start.tolist(), counts.tolist())]
    for letter in set(initial) - {""}:
        fits = model.scripts.get(script(letter))
        if fits is not None and fits.any() and not fits.all():
            here = np.array([x == letter for x in initial])
            rows = totals[here]
            totals[here] = np.where(fits, rows, rows.min(1, keepdims=True) - MOST)
    totals[lettered] = np.maximum(totals[lettered] - totals[lettered].max(1, keepdims=True), -MOST)
    return totals, size, seen


class Scorer:
    """Scores of words, each computed once while the task remembers it."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.words, self.size = Numbered(), 0
        self.scores = np.zeros((0, len(self.model.languages)), np.float32)
        self.letters = self.seen = np.zeros(0, np.int32)

    def codes(self, words: list[str]) -> np.ndarray:
        """Rows of `scores`, `letters` and `seen` for the words."""
        if self.size > REMEMBERED:
            self.clear()
        found, new = self.words.of(words)
        parts = [(self.scores, self.letters, self.seen)]
        for a in range(0, len(new), 20_000):
            scores, letters, seen = word_scores(self.model, new[a : a + 20_000])
            parts.append((scores.astype(np.float32), letters.astype(np.int32), seen.astype(np.int32)))
        if new:
            self.scores, self.letters, self.seen = (np.concatenate(x) for x in zip(*parts))
            self.size += sum(map(len, new)) + WORD_BYTES * len(new)
        return found


def viterbi(emitted: np.ndarray, lengths: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word of every text. `emitted` has the words of all texts one after the other.

    Goes through all texts at once, word by word; texts are taken longest first, so those that
    still have a word are always the first ones.
    """
    label = np.zeros(len(emitted), np.int16)
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    if not longest:
        return label
    first, sizes = starts[order], lengths[order]
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    stays = np.ones(emitted.shape, bool)
    source = np.zeros(len(emitted), np.int16)
    value = emitted[first[: active[0]]]
    last = np.zeros(len(lengths), np.int16)
    for t in range(1, longest):
        n = active[t]
        if n < len(value):
            last[n : len(value)] = value[n:].argmax(1)
            value = value[:n]
        at = first[:n] + t
        came = value.argmax(1)
        floor = (value[np.arange(n), came] - switch)[:, None]
        source[at] = came
        stays[at] = value >= floor
        value = np.maximum(value, floor) + emitted[at]
    last[: len(value)] = value.argmax(1)
    now = last[: active[-1]].copy()
    for t in range(longest - 1, -1, -1):
        n = active[t]
        if n > len(now):
            now = np.concatenate([now, last[len(now) : n]])
        at = first[:n] + t
        label[at] = now
        if t:
            now = np.where(stays[at, now], now, source[at])
    return label


def stretches(labels: np.ndarray, names: tuple[str, ...]) -> str:
    """Labelled stretches as language:first:end, word numbers, comma-joined."""
    cuts = np.flatnonzero(np.diff(labels)) + 1
    edges = [0, *cuts.tolist(), len(labels)]
    return ",".join(f"{names[labels[a]]}:{a}:{b}" for a, b in zip(edges, edges[1:]))


def label(scorer: Scorer, texts: list[bytes], switch: float = SWITCH) -> tuple[list[str], list[float], list[str], list[float]]:
    """Language, score and stretches of each text, and the share of its letters whose 3-gram is known."""
    languages = scorer.model.languages
    if not languages:
        return [NONE] * len(texts), [0.0] * len(texts), [""] * len(texts), [0.0] * len(texts)
    split = [t.decode("utf-8", "replace").lower().split() for t in texts]
    lengths = np.array([len(words) for words in split], np.int64)
    codes = scorer.codes(list(chain.from_iterable(split)))
    del split
    labels = viterbi(scorer.scores[codes], lengths, switch)
    letters = scorer.letters[codes]
    lettered = letters > 0
    ends = np.cumsum(lengths)
    through = np.concatenate([[0], np.cumsum(letters, dtype=np.int64)])
    known = np.concatenate([[0], np.cumsum(scorer.seen[codes], dtype=np.int64)])
    langs, shares, spans, seen = [], [], [], []
    for a, b in zip((ends - lengths).tolist(), ends.tolist()):
        mine = labels[a:b][lettered[a:b]]
        if not len(mine):
            langs.append(NONE), shares.append(0.0), spans.append(""), seen.append(0.0)
            continue
        counts = np.bincount(mine, minlength=len(languages))
        langs.append(languages[int(counts.argmax())])
        shares.append(float(counts.max() / len(mine)))
        spans.append(stretches(labels[a:b], languages))
        seen.append(float((known[b] - known[a]) / max(1, through[b] - through[a])))
    return langs, shares, spans, seen


#: Text that a task labels at a time.
STEP_BYTES = 2_000_000


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, switch: float = SWITCH) -> DataFrame:
    """The columns `keep` (all, if None), `lang_pred`, `lang_score` (share of its words), `lang_spans` and `lang_known` (share of its
    letters whose 3-gram is one of the model's: low for scripts that were not learned and for random letters).

    Texts that are null or have no letter get `und`, score 0 and no span, and so does every text if the
    model knows no language. Ties go to the first language by name. Repeated rows are
    labelled one by one. An empty table gives an empty one. Columns named like the added ones are an
    error.
    """
    keep = docs.columns if keep is None else keep
    added = [("lang_pred", T.StringType()), ("lang_score", T.DoubleType()), ("lang_spans", T.StringType()), ("lang_known", T.DoubleType())]
    clash = sorted({c.lower() for c in keep} & {n for n, _ in added})
    if clash:
        raise ValueError(f"column names in use: {clash}")
    names, width = [*keep, *(n for n, _ in added)], len(keep)
    # a text that is kept travels once
    there = keep.index(text) if text in keep and docs.schema[text].dataType == T.StringType() else None
    body = [] if there is not None else [docs[text].cast("binary").alias("__text")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found = [], [], [], []
            texts = batch.column(width) if there is None else batch.column(there).cast(pa.binary())
            for part in portions(texts, STEP_BYTES):
                for column, cells in zip(found, label(scorer, part, switch)):
                    column += cells
            columns = [pa.array(c, t) for c, t in zip(found, (pa.string(), pa.float64(), pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *columns], names=names)

    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(n, t) for n, t in added)])
    return docs.select(*keep, *body).mapInArrow(thrifty(rows), schema)


def held_out(id: Column) -> Column:
    """True for the fold that is not learned from: CRC-32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
