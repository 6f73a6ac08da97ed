"""Language identification of words, spans and documents.

Training counts the runs of one to four letters in the words of each language
(hashed) over a bounded sample of labelled texts, and which scripts a language is
written in. A word's score in a language is the sum of the log probabilities of
its runs. Scripts come first: a word can only be in the languages that use its
script. Viterbi then labels the words of a document: it takes the sequence of
languages with the highest total, where every change costs ``SWITCH``, and so
finds the spans of mixed texts. The language of a document is the one with the
most letters; its score is their share, weighed by how clearly the words speak for it.
A word is a run without white space. One of more than ``_PIECE`` characters, as in
scripts without spaces, is read whole, as several words one after another.

``und`` with score 0 if the text is null or has no letter. A script no language
was trained on leaves all of them as candidates. Of equal languages the first by name
wins. Without training rows everything is ``und``. Rows may repeat. The work of a
task is bounded by a batch and its longest text; words are scored some thousand at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmullo.llm.common import row_struct, sliced, stage
from murmullo.session import ship_package

BUCKETS = 1 << 15
# Texts that are counted for the model, over all languages.
SAMPLE = 40_000
SWITCH = 12.0
_LONGEST_RUN = 4
# Between two words, so that no run holds letters of both.
_GAP = " " * (_LONGEST_RUN - 1)
# Longer runs without white space are read as several words, a step each.
_PIECE = 40
# Distinct words that are scored at once.
_STEP = 1 << 15
UNKNOWN = "und"

# Where the letters of each script begin and end (code points). Fixed values.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x9FFF), (0x20000, 0x2FFFF)),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
}

_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Script number + 1 of each letter; 0 for what is no letter. Made once a worker."""
    if not _tables:
        is_letter = np.fromiter(
            (chr(i).isalpha() for i in range(0x110000)), bool, count=0x110000
        )
        script = np.full(0x110000, len(SCRIPTS) + 1, np.uint8)
        for i, ranges in enumerate(SCRIPTS.values()):
            for first, last in ranges:
                script[first:last + 1] = i + 1
        _tables.append(np.where(is_letter, script, 0).astype(np.uint8))
    return _tables[0]


@dataclass
class Block:
    """Some of the distinct words of texts: one or more pieces each."""

    points: np.ndarray  # code points; spaces before each word mark its beginning
    kind: np.ndarray  # script number + 1 of each, 0 for what is no letter
    piece: np.ndarray  # the piece of each
    word: np.ndarray  # the distinct word that a piece is of
    letters: np.ndarray  # letters of each piece
    script: np.ndarray  # script of each piece

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Hashed runs of one length after another, and the piece that each is of."""
        place = np.flatnonzero(self.kind)
        behind = place[self.kind[place + 1] == 0] + 1
        lower = np.where(self.kind > 0, self.points, 32).astype(np.uint64)
        value = np.zeros(len(lower), np.uint64)
        for n in range(_LONGEST_RUN):
            # Runs of n + 1 characters that end at a letter, the longest also behind it.
            moved = np.concatenate((np.full(n, 32, np.uint64), lower))[:len(lower)]
            value = value * np.uint64(0x9E3779B97F4A7C15) + moved + np.uint64(1)
            ends = [(place, place)] + [(behind, behind - 1)] * (n == _LONGEST_RUN - 1)
            for at, owner in ends:
                mixed = value[at] ^ (value[at] >> np.uint64(29)) ^ np.uint64(n)
                mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)
                yield (mixed % np.uint64(BUCKETS)).astype(np.int32), self.piece[owner]


def _block(words: list[str]) -> Block:
    points = np.frombuffer((_GAP + _GAP.join(words) + _GAP).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    pieces = np.maximum(1, -(-lengths // _PIECE))
    wide = lengths + len(_GAP)
    inside = np.arange(len(points) - len(_GAP)) - np.repeat(np.cumsum(wide) - wide, wide)
    piece = np.repeat(np.cumsum(pieces) - pieces, wide) + np.maximum(inside - len(_GAP), 0) // _PIECE
    kind = _letters()[points]
    place = np.flatnonzero(kind)
    n = int(pieces.sum())
    # The script of a piece is that of its first letter.
    script = np.zeros(n, np.uint8)
    script[piece[place[::-1]]] = kind[place[::-1]]
    return Block(points, kind, piece.astype(np.int32), np.repeat(np.arange(len(words)), pieces),
                 np.bincount(piece[place], minlength=n).astype(np.int32), script)


@dataclass
class Words:
    """The words of some texts: distinct ones in blocks, and where each stands."""

    distinct: pa.Array
    code: np.ndarray  # number of the distinct word, for every word of the texts
    count: np.ndarray  # words of each text

    def blocks(self) -> Iterator[tuple[int, Block]]:
        """Blocks of at most ``_STEP`` distinct words, and the number of their first."""
        for first in range(0, len(self.distinct), _STEP):
            yield first, _block(self.distinct.slice(first, _STEP).to_pylist())


def words_of(texts: pa.Array) -> Words:
    """Words in lower case."""
    cut = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    count = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = cut.flatten().dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), count)


@dataclass
class Scored:
    """The pieces of some texts with at least one letter, one after another."""

    code: np.ndarray  # number of the distinct piece, for every piece
    count: np.ndarray  # pieces of each text
    letters: np.ndarray  # letters of each distinct piece
    scores: np.ndarray  # score of each distinct piece in each language
    clear: np.ndarray  # how clearly a distinct piece speaks for its best language


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # log probability, bucket by language
    scripts: np.ndarray  # whether a language is written in a script

    def of_block(self, block: Block) -> np.ndarray:
        """Score of each piece in each language."""
        n = len(block.letters)
        out = np.zeros((n, len(self.languages)))
        for bucket, piece in block.runs():
            for i in range(len(self.languages)):
                out[:, i] += np.bincount(piece, weights=self.scores[bucket, i], minlength=n)
        usable = self.scripts[block.script]
        usable = usable | ~usable.any(axis=1, keepdims=True)
        return np.where(usable, out, -1e6).astype(np.float32)

    def of_texts(self, texts: pa.Array) -> Scored:
        """All pieces of the texts; only what a block needs is in memory beside the result."""
        words = words_of(texts)
        pieces, letters, scores, clear = [], [], [], []
        for _, block in words.blocks():
            found = self.of_block(block)
            top = np.partition(found, -2, axis=1)[:, -2:] if found.shape[1] > 1 else found
            margin = (top[:, -1] - top[:, 0]) if found.shape[1] > 1 else np.full(len(found), 9.0, np.float32)
            pieces.append(np.bincount(block.word, minlength=int(block.word[-1]) + 1 if len(block.word) else 0))
            letters.append(block.letters)
            scores.append(found)
            clear.append((1.0 / (1.0 + np.exp(-np.minimum(margin, 30.0)))).astype(np.float32))
        if not pieces:
            return Scored(np.zeros(0, np.int64), np.zeros(len(words.count), np.int64), np.zeros(0, np.int32),
                          np.zeros((0, len(self.languages)), np.float32), np.zeros(0, np.float32))
        size, weight = np.concatenate(pieces), np.concatenate(letters)
        first = np.cumsum(size) - size
        times = size[words.code]
        code = np.repeat(first[words.code] - (np.cumsum(times) - times), times)
        code += np.arange(len(code))
        text_of = np.repeat(np.repeat(np.arange(len(words.count)), words.count), times)
        keep = weight[code] > 0
        return Scored(code[keep], np.bincount(text_of[keep], minlength=len(words.count)), weight,
                      np.concatenate(scores), np.concatenate(clear))


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["_lang", "_kind", "_bucket", "_n"]
    for whole in batches:
        for batch in sliced(whole, 1):
            langs = batch.column(0)
            for lang in pc.unique(langs).to_pylist():
                words = words_of(pc.filter(batch.column(1), pc.equal(langs, lang)))
                times = np.bincount(words.code, minlength=len(words.distinct))
                runs, scripts = np.zeros(BUCKETS), np.zeros(len(SCRIPTS) + 2)
                for first, block in words.blocks():
                    weight = times[first + block.word]
                    for bucket, piece in block.runs():
                        runs += np.bincount(bucket, weights=weight[piece], minlength=BUCKETS)
                    scripts += np.bincount(block.script, weights=weight * (block.letters > 0),
                                           minlength=len(scripts))
                for kind, found in ((0, runs), (1, scripts)):
                    at = np.flatnonzero(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(at), pa.string()),
                         pa.array(np.full(len(at), kind, np.int32)),
                         pa.array(at), pa.array(found[at].astype(np.int64))], names=names)


def sample_shares(counts: dict[str, int], sample: int) -> dict[str, float]:
    """What part of each language's rows is counted so that all get the same number of
    rows, as far as they have them, and ``sample`` in all."""
    shares, left = {}, sample
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        taken = min(n, max(1, left // (len(counts) - i)))
        shares[lang] = taken / n
        left -= taken
    return shares


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Count the runs of the labelled texts (``lang``, ``text``, ``doc_id``).

    About ``sample`` rows are counted, the same number of every language that has so
    many, chosen by a hash of id and text; they take part whole. What comes to the
    driver is a number per language and bucket.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string"), "text", F.col("doc_id").cast("string").alias("_id"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    shares = spark.createDataFrame(
        [(lang, int(share * (1 << 30))) for lang, share in sample_shares(counts, sample).items()],
        "lang string, _share long")
    # As many rows as the model has columns, so small enough for every task.
    chosen = rows.join(F.broadcast(shares), "lang").filter(
        F.pmod(F.xxhash64("_id", "text"), F.lit(1 << 30)) < F.col("_share"))
    found = (
        chosen.select("lang", "text")
        .mapInArrow(_counter, "_lang string, _kind int, _bucket bigint, _n bigint")
        .groupBy("_lang", "_kind", "_bucket").agg(F.sum("_n").alias("_n"))
    ).toPandas()
    languages = sorted(found["_lang"].unique())
    number = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((len(SCRIPTS) + 2, len(languages)))
    which = found["_lang"].map(number).to_numpy(np.int64) if len(found) else np.zeros(0, np.int64)
    bucket, n, kind = (found[c].to_numpy() for c in ("_bucket", "_n", "_kind"))
    for table, k in ((counts, 0), (scripts, 1)):
        rows_of = kind == k
        table[bucket[rows_of].astype(np.int64), which[rows_of]] = n[rows_of]
    smooth = (counts + 0.5) / (counts.sum(axis=0, keepdims=True) + 0.5 * BUCKETS)
    used = scripts >= 0.01 * np.maximum(1, scripts.sum(axis=0, keepdims=True))
    return Model(languages, np.log(smooth).astype(np.float32), used)


def best_paths(scores: np.ndarray, code: np.ndarray, count: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi for all texts side by side: the language number of every word.

    ``scores`` by distinct word; ``code`` the words of all texts, one after another.
    """
    out = np.zeros(len(code), np.int64)
    order = np.argsort(-count, kind="stable")
    order = order[count[order] > 0]
    if not len(order):
        return out
    starts = (np.cumsum(count) - count)[order]
    sizes = count[order]
    alive = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    n_langs = scores.shape[1]
    came = np.empty((len(code), n_langs), np.int16)
    own = np.arange(n_langs)
    total = scores[code[starts]].astype(np.float64)
    for t in range(1, int(sizes[0])):
        a = int(alive[t])
        now = total[:a]
        best = now.argmax(axis=1)
        jump = now[np.arange(a), best][:, None] - switch
        stay = now >= jump
        came[starts[:a] + t] = np.where(stay, own, best[:, None])
        total[:a] = np.where(stay, now, jump) + scores[code[starts[:a] + t]]
    state = np.zeros(len(order), np.int64)
    for t in range(int(sizes[0]) - 1, -1, -1):
        a = int(alive[t])
        ends = sizes[:a] == t + 1
        state[:a][ends] = total[:a][ends].argmax(axis=1)
        at = starts[:a] + t
        out[at] = state[:a]
        if t:
            state[:a] = came[at, state[:a]]
    return out


def _labeller(model: Model, switch: float):
    n_langs = len(model.languages)
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    spans_type = pa.list_(pa.struct([
        ("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))

    def label(texts: pa.Array) -> list[pa.Array]:
        words = model.of_texts(texts)
        path = best_paths(words.scores, words.code, words.count, switch)
        text_of = np.repeat(np.arange(len(words.count)), words.count)
        weight = words.letters[words.code]
        by_lang = np.bincount(
            text_of * n_langs + path, weights=weight, minlength=len(words.count) * n_langs
        ).reshape(-1, n_langs)
        total = by_lang.sum(axis=1)
        pred = np.where(total > 0, by_lang.argmax(axis=1), n_langs)
        # How clearly the words speak for their language against the next one.
        agreed = (path == pred[text_of]) * weight * words.clear[words.code]
        score = np.bincount(text_of, weights=agreed, minlength=len(total)) / np.maximum(total, 1)
        change = np.ones(len(path), bool)
        change[1:] = (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1])
        first = np.flatnonzero(change)
        size = np.diff(np.append(first, len(path)))
        begin = (np.cumsum(words.count) - words.count)[text_of[first]]
        per_text = np.bincount(text_of[first], minlength=len(total))
        spans = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)),
            pa.StructArray.from_arrays(
                [pa.array(first - begin), pa.array(size),
                 pa.array(names[path[first]].tolist(), pa.string())],
                fields=list(spans_type.value_type)),
        )
        return [pa.array(names[pred].tolist(), pa.string()),
                pa.array(np.clip(np.where(total > 0, score, 0.0), 0.0, 1.0)), spans]

    # What a text's words take grows with the languages; slices shrink with them.
    most = min(4 << 20, (64 << 20) // max(1, n_langs))

    def text_of_row(batch: pa.RecordBatch) -> pa.Array:
        return batch.column(1) if batch.num_columns > 1 else batch.column(0).field("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, text_of_row(whole), most):
                if n_langs:
                    found = label(text_of_row(batch))
                else:
                    n = batch.num_rows
                    found = [pa.array([UNKNOWN] * n), pa.array([0.0] * n),
                             pa.array([[]] * n, spans_type)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *found], names=["_doc", "lang_pred", "score", "spans"]
                )

    return run


def identified(docs: DataFrame, model: Model, switch: float = SWITCH, with_text: bool = True) -> DataFrame:
    """Every row as ``_doc`` with ``lang_pred``, ``score`` and ``spans``.

    ``_doc`` has all columns, or all but ``text``.
    """
    ship_package(docs.sparkSession)
    if with_text:  # the text lies in the row, and is sent once
        rows = docs.select(row_struct(docs).alias("_doc"))
    else:
        rows = docs.select(row_struct(docs.drop("text")).alias("_doc"), "text")
    kind = rows.schema["_doc"].dataType.simpleString()
    return rows.mapInArrow(
        _labeller(model, switch), f"_doc {kind}, lang_pred string, score double, "
        "spans array<struct<first_word: bigint, n_words: bigint, lang: string>>",
    )


def held_out(doc_id: Column) -> Column:
    """One document in five is never learned from; a null id is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def language_table(docs: DataFrame, sample: int = SAMPLE, switch: float = SWITCH) -> DataFrame:
    """Learn from the documents that are not held out, and label all."""
    model = learn(docs.filter(~held_out(F.col("doc_id"))), sample)
    return identified(docs.select("doc_id", "text"), model, switch, with_text=False).select(
        F.col("_doc.doc_id").alias("doc_id"), held_out(F.col("_doc.doc_id")).alias("held_out"),
        "lang_pred", "score",
    )


def in_a_language(docs: DataFrame, sample: int = SAMPLE, switch: float = SWITCH) -> DataFrame:
    """The rows whose language is known; a text in several languages has its main one."""
    model = learn(docs.filter(~held_out(F.col("doc_id"))), sample)
    return identified(docs, model, switch).filter(F.col("lang_pred") != UNKNOWN).select("_doc.*")
