import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from weirframe.llm import packing
from weirframe.llm.queries import op1_packing, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
PATH = tokenizer_path("byte_bpe_50k.json")
ODD = [
    "", " ", "  a  b \n\n c\t\td ", "x<|endoftext|>y  <|endoftext|> z", "\xa0\x1c é  q  ", "it's I'll  we've", "a.b, c!! d.) e",
    "3.14 x2. 7, (a) \"q\" 'tis don't.", "日本 語。  x", " lead", "trail ", "word\r\nnext", "é. É!", "ýz. a",
]


def check_pieces(rows, ids_of, capacity=2048):
    """Every id in one piece, sequences gapless and whole; returns the padding."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append(r)
    padding = 0
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    assert docs.keys() == ids_of.keys()
    for doc_id, pieces in docs.items():
        ids, at = np.array([*ids_of[doc_id], 1], "<u4"), 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    return padding


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    plain = Tokenizer.from_file(PATH)
    ids_of = {r["doc_id"]: plain.encode(r["text"], add_special_tokens=False).ids for r in docs}
    assert check_pieces(op1_packing(spark, SF_DIR).collect(), ids_of) == 0


def test_odd_texts_are_encoded_as_a_whole_text_is():
    plain, encoder = Tokenizer.from_file(PATH), packing.ChunkEncoder(PATH)
    rng = random.Random(3)
    parts = ["a", "The", " ", "  ", "\n", ".", ",", "!!", "'s", "é", "12", "<|endoftext|>", "\t", " ", "-", "日"]
    texts = [*ODD, *("".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000))]
    for _ in range(2):
        found = encoder.encode(texts)
        for text, ids in zip(texts, found, strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_forgetting_keeps_ids(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    plain, encoder = Tokenizer.from_file(PATH), packing.ChunkEncoder(PATH)
    for k in range(30):
        texts = [f"the w{k} w{k + 1}. of x{i}y, the" for i in range(k)]
        assert [ids.tolist() for ids in encoder.encode(texts)] == [plain.encode(t).ids for t in texts]


def test_fill_comes_closest():
    rng = random.Random(1)
    for _ in range(200):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        room = rng.randint(1, 60)
        pool = {n: [None] * lengths.count(n) for n in lengths}
        taken = packing.fill(pool, sorted(pool), room)
        best = max(
            s for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if (s := sum(c)) <= room
        )
        assert sum(length * used for length, used in taken) == best
        assert all(used <= len(pool[length]) for length, used in taken)


@pytest.mark.parametrize("pool", [(6000, 2000), (4, 2)])
def test_packer_without_padding(monkeypatch, pool):
    monkeypatch.setattr(packing, "POOL", pool[0])
    monkeypatch.setattr(packing, "KEPT", pool[1])
    rng = random.Random(2)
    packer, rows, ids_of = packing.Packer(64, 5), [], {}
    for doc_id in range(150):
        ids_of[doc_id] = [rng.randint(0, 9) for _ in range(rng.choice([0, 1, 40, 63, 64, 200]))]
        rows += packer.add(doc_id, np.array([*ids_of[doc_id], 1], "<u4"))
    rows += packer.rest()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check_pieces([dict(zip(names, row, strict=True)) for row in rows], ids_of, 64) == 0


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "a b", 5), (3, "w " * 50_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    plain = Tokenizer.from_file(PATH)
    ids_of = {i: plain.encode(t or "").ids for i, t, _ in rows}
    assert check_pieces(packing.pack(docs, PATH).collect(), ids_of) == 0
    assert packing.pack(docs.limit(0), PATH).count() == 0
