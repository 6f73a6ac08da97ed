import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from murmullo.llm.token_counts import token_counts, tokenizer_version
from murmullo.llm.token_files import pack, read_ranks, read_tokens, token_table, unpack, write_tokens
from murmullo.llm.tokens import Encoder

FILES = {n: public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}
ODD = [
    "", " ", "a  b\n\n c \n", "it's <|endoftext|> don't  <|startoftext|>x", "n\xa0a \x85 x  y",
    "日本語 テスト。 ok", "é é É ÀÉ a̸ ̸ ≠", "\t\tcode  {x: 1}\n  y = 'z'  ", "İstanbul ŠĐ",
    "x y z\x1cw \x1d", "ß ẞ ſ K Å", "12 34a5 a1", "😀 a😀b 👩‍👩‍👧", "a\r\nb\r\n\r\n c", "x <| y <|endoftext|",
    "a`b~c^d <x> |y|", "l'été aujourd'hui 'S 'll", "　全 角　 ", "word " * 20_000,
]


@pytest.fixture(scope="module", params=sorted(FILES))
def pair(request):
    return Encoder(FILES[request.param]), Tokenizer.from_file(FILES[request.param])


def _same(encoder, library, texts):
    ids, counts = encoder.encode(texts)
    found = np.split(np.frombuffer(ids, encoder.dtype), np.cumsum(counts)[:-1])
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [f.tolist() for f in found] == expected


def test_pieces_give_the_ids_of_whole_texts(pair):
    _same(*pair, ODD)
    rng = random.Random(3)
    signs = "ab É é  \n\t'1.<|!😀ñ \xa0́"
    _same(*pair, ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(2000)])


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_any_text(texts):
    for path in FILES.values():
        _same(_encoder(path), _library(path), texts)


_made = {}


def _encoder(path):
    return _made.setdefault(("e", path), Encoder(path))


def _library(path):
    return _made.setdefault(("t", path), Tokenizer.from_file(path))


@settings(max_examples=100, deadline=None)
@given(ranks=st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=40))
def test_packing_round_trip(ranks):
    control, data = pack(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert unpack(control, data, len(ranks)).tolist() == ranks


def test_frequent_ids_take_one_byte():
    _, data = pack(np.array([0, 255, 256, 65535, 65536, 2**24], np.uint32))
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 4


def _expected(rows, path, end=2):
    library, at, out = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[1])


def test_token_files(spark, corpus, tmp_path):
    rows, docs = corpus
    path, folder = FILES["word_bpe_49k.json"], str(tmp_path / "t")
    expected = _expected([r[:2] for r in rows], path)
    write_tokens(docs, path, folder)
    assert _sorted(read_tokens(spark, folder).collect()) == expected
    # The ids by rank: the most frequent first.
    library = Tokenizer.from_file(path)
    counts = np.bincount([2] * len(rows) + [i for r in rows for i in library.encode(r[1], add_special_tokens=False).ids])
    ranked = read_ranks(spark, folder)
    assert counts[ranked].tolist() == sorted(counts[counts > 0].tolist(), reverse=True)
    assert _sorted(token_table(docs.repartition(2), path).collect()) == expected


def test_token_files_of_edges(spark, edges, edge_rows, nothing):
    path = FILES["word_bpe_49k.json"]
    assert _sorted(token_table(edges, path).collect()) == _expected([r[:2] for r in edge_rows], path)
    assert token_table(nothing, path).collect() == []


def test_token_counts(spark, corpus, edges, edge_rows, nothing, tmp_path):
    path, cache = FILES["byte_bpe_50k.json"], str(tmp_path / "cache")
    library = Tokenizer.from_file(path)

    def expected(rows, limit):
        out = []
        for doc_id, text in rows:
            n = len(library.encode(text or "", add_special_tokens=False).ids)
            out.append((doc_id, len((text or "").encode()), n, n > limit))
        return sorted(out, key=str)

    def found(docs, **how):
        return sorted(map(tuple, token_counts(docs, path, **how).collect()), key=str)

    rows = [r[:2] for r in corpus[0]]
    assert found(corpus[1], cache=cache, limit=100) == expected(rows, 100)
    distinct = len({t for _, t in rows})
    stored = spark.read.parquet(cache)
    assert stored.count() == distinct
    digest = {bytes(r.digest) for r in stored.collect()}
    assert digest == {hashlib.sha256(t.encode()).digest() for _, t in rows}
    # Nothing is encoded a second time; another version is.
    assert found(corpus[1], cache=cache) == expected(rows, 1024)
    assert spark.read.parquet(cache).count() == distinct
    edge = [r[:2] for r in edge_rows]
    assert found(edges, cache=cache) == expected(edge, 1024)
    new = len({t or "" for _, t in edge} - {t for _, t in rows})
    assert spark.read.parquet(cache).count() == distinct + new
    assert found(nothing) == []
    assert tokenizer_version(path) != tokenizer_version(FILES["word_bpe_49k.json"])


def test_a_cache_of_several_versions_gives_what_the_table_needs(spark, tmp_path):
    """Counts of other versions and other texts are in the cache and stay out."""
    cache = str(tmp_path / "cache")
    path = public_tokenizers.path("byte_bpe_50k.json")
    some = spark.createDataFrame([(1, "uno dos"), (2, "tres"), (3, None)], "doc_id bigint, text string")
    more = spark.createDataFrame([(4, "uno dos"), (5, "cuatro cinco seis")], "doc_id bigint, text string")
    first = {r.doc_id: r.n_tokens for r in token_counts(some, path, cache).collect()}
    token_counts(more, public_tokenizers.path("word_bpe_49k.json"), cache).collect()
    second = {r.doc_id: r.n_tokens for r in token_counts(more, path, cache).collect()}
    assert set(second) == {4, 5} and second[4] == first[1]
    versions = spark.read.parquet(cache).groupBy("version").count().collect()
    assert sorted(r["count"] for r in versions) == [2, 4]


def test_texts_are_encoded_a_few_megabytes_at_once(monkeypatch):
    import murmullo.llm.token_files as files

    sizes = []

    class Fake:
        dtype = np.uint16

        def encode(self, texts):
            sizes.append(sum(map(len, texts)))
            return b"", np.zeros(len(texts), np.int64)

    monkeypatch.setattr(files, "encoder", lambda path: Fake())
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(12)), pa.array(range(12)), pa.array(["x" * (1 << 20)] * 12)], names=["doc_id", "_hash", "text"])
    out = list(files._tokenizing("", 2)(iter([batch])))
    assert sum(b.num_rows for b in out) == 12 and sum(sizes) == 12 << 20 and max(sizes) <= 4 << 20
