"""Language of texts and of spans within them, learned from labelled texts.

A word's script, told by the code-point range of its first letter, leaves the
languages that use this script in the training texts. Each word then gets a score
per language from its character runs of one to four letters, and the best path
through the words of a text, with a penalty for each change of language, labels
its spans. One more state is the unknown: it scores a word as text of a language
that was not learned would, and has the words of scripts that no language uses. The
text gets the language that most of its letters are in.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.ragged import SLICE_BYTES, Words, mixed, split_words, text_slices
from ledgermill.llm.rows import keep_rows

UNKNOWN = "und"
ORDERS = 4
BUCKETS = 1 << 16
#: Added to every count, so unseen character runs keep some probability.
SMOOTHING = 0.5
#: Cost in nats of changing the language between two words.
SWITCH_PENALTY = 10.0
#: A language uses a script if at least this share of its words is written in it.
SCRIPT_SHARE = 0.01
IMPOSSIBLE = np.float32(-1e4)
#: Where the unknown scores a character run, between a run drawn evenly (0) and the mean of the language's own (1).
BACKGROUND = 0.4

#: First code points of the ranges, and the script of each; "" is none of these.
SCRIPT_RANGES = [
    (0x0000, ""), (0x0041, "Latin"), (0x0250, ""), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
    (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, ""), (0x0750, "Arabic"), (0x0780, ""), (0x08A0, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, ""), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, ""),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""), (0x3040, "Kana"), (0x3130, "Hangul"), (0x3190, ""),
    (0x3400, "Han"), (0xA000, ""), (0xAC00, "Hangul"), (0xD7B0, ""), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, ""), (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"),
    (0xFFA0, ""), (0x20000, "Han"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})


@dataclass
class VocabularyRuns:
    """Character runs of the distinct words of a slice."""

    runs: np.ndarray  # bucket of each run
    owners: np.ndarray  # the word it stands in
    scripts: np.ndarray  # script number of each word
    letters: np.ndarray  # letters of each word


def is_letter(points: np.ndarray, known: dict[int, bool]) -> np.ndarray:
    """Letters and the marks that belong to them."""
    distinct, place = np.unique(points, return_inverse=True)
    for code in distinct.tolist():
        if code not in known:
            known[code] = unicodedata.category(chr(code))[0] in "LM"
    return np.array([known[c] for c in distinct.tolist()], bool)[place]


def vocabulary_runs(words: Words, known: dict[int, bool]) -> VocabularyRuns:
    """Lower-cased letters of each distinct word, in runs that may take in its start and end."""
    size = len(words.vocabulary)
    # No word holds a line break, so it can stand between them.
    joined = b"\n".join([b"", *words.vocabulary.to_pylist(), b""]).decode("utf-8").lower()
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    gap = points == 10
    kept = gap | is_letter(points, known)
    points, gap = points[kept], gap[kept]
    owner = np.cumsum(gap) - 1
    letters = np.bincount(owner[~gap], minlength=size + 1)[:size]
    first = np.flatnonzero(gap)[:size] + 1
    starts = np.array([a for a, _ in SCRIPT_RANGES])
    numbers = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])
    scripts = numbers[np.searchsorted(starts, points[np.minimum(first, len(points) - 1)], side="right") - 1]
    scripts = np.where(letters > 0, scripts, SCRIPTS.index(""))
    runs, owners = [], []
    total = len(points)
    for order in range(1, ORDERS + 1):
        count = max(0, total - order + 1)
        h = np.full(count, order, np.uint64)
        whole = np.ones(count, bool)
        for k in range(order):
            h = mixed(h + points[k : k + count].astype(np.uint64))
            if order == 1 or 0 < k < order - 1:
                whole &= ~gap[k : k + count]
        # Two marks of word bounds with nothing between are no run of letters.
        if order == 2:
            whole &= ~(gap[:count] & gap[1 : 1 + count])
        places = np.flatnonzero(whole)
        runs.append((h[places] % np.uint64(BUCKETS)).astype(np.int64))
        owners.append(np.where(gap[places], owner[places], owner[places + order - 1] - gap[places + order - 1]))
    return VocabularyRuns(np.concatenate(runs), np.concatenate(owners), scripts, letters)


@dataclass
class LanguageModel:
    languages: list[str]
    scores: np.ndarray  # log-probability of each bucket in each language, shared out over the orders
    allowed: np.ndarray  # of each script and language
    background: np.ndarray  # score of a run of the unknown, beside each language


def train_language_model(docs: DataFrame, language_column: str = "lang", text_column: str = "text") -> LanguageModel:
    """Learn from all rows with a language and a text.

    Each task counts into a table of fixed size per language (``BUCKETS``), so
    what is shuffled and sent to the driver is bounded by the languages, not by
    the texts. Without any labelled row the model has no languages.
    """
    labelled = docs.select(F.col(language_column).alias("lang"), F.col(text_column).alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    width = BUCKETS + len(SCRIPTS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        known: dict[int, bool] = {}
        for part in text_slices(batches):
            words = split_words(part.column("text"))
            found = vocabulary_runs(words, known)
            languages = np.array(part.column("lang").to_pylist(), dtype=object)
            of_word = languages[words.document()]
            for language in dict.fromkeys(languages.tolist()):
                times = np.bincount(words.codes[of_word == language], minlength=len(words.vocabulary))
                total = totals.setdefault(language, np.zeros(width, np.int64))
                total[:BUCKETS] += np.bincount(found.runs, times[found.owners], BUCKETS).astype(np.int64)
                total[BUCKETS:] += np.bincount(found.scripts, times * (found.letters > 0), len(SCRIPTS)).astype(np.int64)
        for language, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(some)), pa.array(some), pa.array(total[some])], names=["lang", "slot", "n"]
            )

    rows = (
        labelled.mapInArrow(counted, "lang string, slot bigint, n bigint")
        .groupBy("lang", "slot")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(rows["lang"].unique().tolist())
    counts = np.zeros((width, len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    counts[rows["slot"].to_numpy(np.int64), rows["lang"].map(place).to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    runs, scripts = counts[:BUCKETS], counts[BUCKETS:]
    total = runs.sum(axis=0)
    scores = np.log((runs + SMOOTHING) / (total + SMOOTHING * BUCKETS)) / ORDERS
    # A language of few texts is hardly known itself, so its unknown stays near runs drawn evenly.
    even, sure = -np.log(BUCKETS) / ORDERS, total / (total + SMOOTHING * BUCKETS)
    own = (runs * scores).sum(axis=0) / np.maximum(total, 1)
    background = even + BACKGROUND * sure * np.maximum(own - even, 0)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return LanguageModel(languages, scores.astype(np.float32), allowed, background.astype(np.float32))


def word_scores(words: Words, model: LanguageModel, known: dict[int, bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score of each distinct word in each language and the unknown, its letters, and whether no language uses its script.

    Words without letters and of scripts that no language uses score 0.
    """
    found = vocabulary_runs(words, known)
    size, width = len(words.vocabulary), len(model.languages)
    scores = np.zeros((size, width + 1), np.float32)
    for k in range(width):
        scores[:, k] = np.bincount(found.owners, model.scores[found.runs, k], size)[:size]
    foreign = (found.letters > 0) & ~model.allowed[found.scripts].any(axis=1)
    scores[:, :width][~model.allowed[found.scripts] & (found.letters > 0)[:, None]] = IMPOSSIBLE
    # The unknown beside the language that the word fits best.
    scores[:, width] = np.bincount(found.owners, minlength=size)[:size] * model.background[scores[:, :width].argmax(axis=1)]
    scores[(found.letters == 0) | foreign] = 0
    return scores, found.letters, foreign


def best_paths(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word, for all texts at once; the last one is the unknown.

    ``scores[bounds[i]:bounds[i + 1]]`` are the words of text ``i``. Texts are
    walked in step, longest first; from one word to the next a text keeps its
    language or pays the penalty for the best other one.
    """
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    first, length = bounds[:-1][order], counts[order]
    steps = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(steps), side="left")  # texts longer than each step
    path = np.zeros(len(scores), np.int32)
    if not steps:
        return path
    kept = np.ones(scores.shape, bool)
    origin = np.zeros(len(scores), np.int32)
    value = np.zeros((len(order), scores.shape[1]), np.float32)
    value[: alive[0]] = scores[first[: alive[0]]]
    # A text is taken to be of a language until its words say otherwise.
    value[: alive[0], -1] -= np.float32(penalty)
    for t in range(1, steps):
        here = value[: alive[t]]
        at = first[: alive[t]] + t
        best = here.argmax(axis=1)
        other = np.take_along_axis(here, best[:, None], 1) - np.float32(penalty)
        origin[at] = best
        kept[at] = here >= other
        # Keep the numbers small: only differences count.
        value[: alive[t]] = np.maximum(here, other) - other + scores[at]
    state = value.argmax(axis=1).astype(np.int32)
    for t in range(steps - 1, -1, -1):
        at = first[: alive[t]] + t
        now = state[: alive[t]]
        path[at] = now
        state[: alive[t]] = np.where(kept[at, now], now, origin[at])
    return path


@dataclass
class Labelled:
    """Languages of texts: of each word on the best path, and of each text with its share of letters."""

    words: Words
    path: np.ndarray
    best: np.ndarray  # the language of most letters
    share: np.ndarray  # of that language by letters
    unknown: np.ndarray  # share of letters of no known language
    total: np.ndarray  # letters of each text


def labelled_texts(column: pa.Array, model: LanguageModel, known: dict[int, bool], penalty: float) -> Labelled:
    """Label texts with a model that knows a language at least."""
    rows, width = len(column), len(model.languages)
    words = split_words(column)
    scores, letters, foreign = word_scores(words, model, known)
    path = best_paths(scores[words.codes], words.bounds, penalty)
    path[foreign[words.codes]] = width
    weight = letters[words.codes]
    shares = np.bincount(words.document() * (width + 1) + path, weight, rows * (width + 1)).reshape(rows, width + 1)
    total = shares.sum(axis=1)
    best = shares[:, :width].argmax(axis=1)
    share = shares[np.arange(rows), best]
    return Labelled(words, path, best, share / np.maximum(total, 1), shares[:, width] / np.maximum(total, 1), total)


def label_languages(
    docs: DataFrame,
    model: LanguageModel,
    id_column: str = "doc_id",
    text_column: str = "text",
    penalty: float = SWITCH_PENALTY,
) -> DataFrame:
    """``id_column``, lang_pred, score, unknown and spans of each row.

    ``lang_pred`` is the language of most letters on the best path (at a tie the
    first by name), ``score`` the share of letters in it, ``spans`` the runs of
    words of one language (first word, words, language). A text that is NULL or
    has no letter is ``und`` with score 0 and no spans, as is every text if the
    model knows no language. ``unknown`` is the share of letters of no known language;
    they count against the score and are in no span. A text of such letters alone
    has score 0 and the first language by name. Rows of equal or NULL id keep a
    result each.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.scores, model.allowed, model.background))
    kind = docs.schema[id_column].dataType.simpleString()

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageModel(*shared.value)
        if not model.languages:
            # One language that no text is given.
            model = LanguageModel([UNKNOWN], np.zeros((BUCKETS, 1), np.float32), np.ones((len(SCRIPTS), 1), bool), np.zeros(1, np.float32))
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        known: dict[int, bool] = {}
        width = max(1, len(model.languages))
        for part in text_slices(batches, limit=max(1 << 18, SLICE_BYTES * 8 // max(8, width))):
            rows = part.num_rows
            found = labelled_texts(part.column("text"), model, known, penalty)
            words, path, best, share, total = found.words, found.path, found.best, found.share, found.total
            document = words.document()
            change = np.ones(len(path), bool)
            change[1:] = (path[1:] != path[:-1]) | (document[1:] != document[:-1])
            begin = np.flatnonzero(change & (total[document] > 0) & (names[path] != UNKNOWN))
            stop = np.append(np.flatnonzero(change), len(path))
            size = stop[np.searchsorted(stop, begin, side="right")] - begin if len(begin) else begin
            spans = pa.StructArray.from_arrays(
                [
                    pa.array(begin - words.bounds[document[begin]], pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(names[path[begin]].tolist(), pa.string()),
                ],
                names=["first_word", "n_words", "lang"],
            )
            offsets = np.searchsorted(document[begin], np.arange(rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(np.where(total > 0, names[best], UNKNOWN).tolist(), pa.string()),
                    pa.array(np.where((total > 0) & (names[best] != UNKNOWN), share, 0.0)),
                    pa.array(np.where(total > 0, found.unknown, 0.0)),
                    pa.ListArray.from_arrays(pa.array(offsets), spans),
                ],
                names=[id_column, "lang_pred", "score", "unknown", "spans"],
            )

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        labelled,
        f"`{id_column}` {kind}, lang_pred string, score double, unknown double, "
        "spans array<struct<first_word: bigint, n_words: bigint, lang: string>>",
    )


def keep_languages(
    docs: DataFrame, model: LanguageModel, least: float, text_column: str = "text", penalty: float = SWITCH_PENALTY
) -> DataFrame:
    """The rows whose text has a known language with at least the share ``least`` of its letters, and no more unknown ones."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.scores, model.allowed, model.background))

    def wanted(column: pa.Array) -> np.ndarray:
        if not shared.value[0]:
            return np.zeros(len(column), bool)
        found = labelled_texts(column, LanguageModel(*shared.value), {}, penalty)
        return (found.total > 0) & (found.share >= least) & (found.unknown <= found.share)

    return keep_rows(docs, text_column, wanted)


def held_out(id_column: str, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the id as text falls in the fold; FALSE for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % folds == fold, F.lit(False))
