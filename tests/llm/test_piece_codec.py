import random
import zlib

import numpy as np
import sentencepiece

from weirframe.llm import piece_codec as P
from weirframe.llm.queries import op6_pieces, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
PATH = tokenizer_path("piece_bpe_32k.model")


def test_given_table_as_the_library_encodes_it(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = op6_pieces(spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        assert list(r["ids"]) == library.encode(texts[r["doc_id"]])
        assert r["n_ids"] == len(r["ids"]) and r["round_trip"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())


def test_random_texts_as_the_library_encodes_them(monkeypatch):
    monkeypatch.setattr(P, "REMEMBERED", 50)
    monkeypatch.setattr(P, "PAIR_BITS", 6)  # pairs collide in the small table
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoder = P.Encoder(P.Vocabulary.load(PATH))
    rng = random.Random(1)
    parts = ["a", "aa", " ", "  ", "▁", "é", "日本", "\n", "\t", "the", "😀", "xxxxx", "<s>", "\0", "Zz", "....", "==", "1234", "ion", "<0x41>"]
    for _ in range(8):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(100)]
        found = encoder.encode(texts)
        for text, ids in zip(texts, found, strict=True):
            assert ids.tolist() == library.encode(text), repr(text)
            assert P.decode(ids, encoder.vocabulary.decoded) == text.replace("▁", " ")


def test_suffix_order_and_occurrences():
    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(300))
    codes = np.frombuffer(text.encode("utf-32-le"), np.int32)
    order = P.suffix_order(codes, 8)
    assert [text[k : k + 8] for k in order] == sorted(text[k : k + 8] for k in range(len(text)))
    words = ["a", "b", "ab", "ba", "aab", "bbbb", "abababab", "c"]
    wanted = np.full((len(words), 8), -2, np.int32)
    for row, word in enumerate(words):
        wanted[row, : len(word)] = np.frombuffer(word.encode("utf-32-le"), np.int32)
    low, high = P.occurrences(codes, order, wanted, np.array([len(w) for w in words]))
    for row, word in enumerate(words):
        assert sorted(order[low[row] : high[row]]) == [k for k in range(len(text)) if text.startswith(word, k)]


def test_odd_rows(spark):
    rows = [(1, None, 3), (2, "", 3), (None, " ", 3), (3, "ab" * 3000, 3), (2, "", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = {(r["doc_id"], r["n_ids"], r["round_trip"]) for r in P.encode_decode(docs, PATH).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    long = len(library.encode("ab" * 3000))
    assert found == {(1, None, None), (2, 0, True), (None, len(library.encode(" ")), True), (3, long, True)}
    assert P.encode_decode(docs.limit(0), PATH).count() == 0


def test_a_table_of_ids_is_decoded(spark):
    rows = [(1, "Hello  wörld\n\t😀", 3), (2, "", 3), (3, None, 3), (None, "again again", 3), (1, "Hello  wörld\n\t😀", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    encoded = P.encode_decode(docs, PATH).withColumn("text", P.F.lit("x"))
    found = [(r["doc_id"], r["text"]) for r in P.decode_table(encoded, PATH).collect()]
    assert sorted(found, key=repr) == sorted([(i, text) for i, text, _ in rows], key=repr)
    assert P.decode_table(encoded.limit(0), PATH).count() == 0


def test_suffix_order_sorts_many_codes_at_once(monkeypatch):
    rng = random.Random(4)
    sort, sorts = np.argsort, []
    monkeypatch.setattr(P.np, "argsort", lambda *a, **k: sorts.append(1) or sort(*a, **k))
    for letters, most in ((2, 1), (120, 2), (250, 3), (5000, 4)):  # doubling alone sorts five times
        for n in (1, 2, 5, 3000):
            codes = np.array([0x10FFFF - 7 * rng.randrange(letters) for _ in range(n)], np.int32)
            codes[rng.randrange(n)] = 0
            sorts.clear()
            order = P.suffix_order(codes, 16).tolist()
            assert len(sorts) <= most
            assert sorted(order) == list(range(n))
            found = [codes[k : k + 16].tolist() for k in order]
            assert found == sorted(found)
