import random
import re
import zlib
from collections import Counter

from weirframe.llm import spelling as P
from weirframe.llm.queries import op13_spelling, table
from weirframe.session import Scratch

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def plain_words(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def is_near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1 :] == b[k + 1 :]
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return long[k + 1 :] == short[k:]


def plain_variants(docs):
    n = plain_words(docs)
    near = {w: [o for o in n if is_near(w, o)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), None if form[w] is None else n[form[w]]))
    return sorted(rows)


def found(spark, docs):
    with Scratch(spark, "t") as scratch:
        frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int")
        return sorted(tuple(r) for r in P.variants(frame, scratch).collect())


def test_given_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()]
    rows = sorted(tuple(r) for r in op13_spelling(spark, "/root/testdata/sf0.01").collect())
    assert rows == plain_variants(docs)
    assert sum(r[1] is not None for r in rows) > 0 and any(r[4] > 1 for r in rows)


def test_variants_of_few_letters(spark):
    rng = random.Random(1)
    docs = []
    for k in range(400):
        words = ["".join(rng.choice("aabÀß") for _ in range(rng.choice((5, 6, 6, 7, 8)))) for _ in range(60)]
        docs.append((k, rng.choice((" ", "-", "9")).join(w.upper() if w.isascii() and rng.random() < 0.2 else w for w in words)))
    docs += [(None, "aabaab " * 7), (500, None), (501, ""), (3, docs[3][1]), (3, docs[3][1])]
    assert found(spark, docs) == plain_variants(docs)


def test_chains_ties_and_edits_at_every_place(spark):
    chain = {"abcdefgh": 700, "abcdefg": 130, "abcdef": 20, "xbcdef": 4, "abcdeg": 5}
    word = "lmnopqrstu"
    edits = [word[:k] + word[k + 1 :] for k in range(10)] + [word[:k] + "z" + word[k:] for k in range(11)]
    edits += [word[:k] + "y" + word[k + 1 :] for k in range(10)]
    counts = {**chain, word: 60, **dict.fromkeys(edits, 6), "aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 25, "×÷×÷×÷": 9, "ÀÀÀÀÀÀ": 9, "àÀÀÀÀÀ": 45}
    docs = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items())]
    rows = found(spark, docs)
    assert rows == plain_variants(docs)
    by_word = {r[0]: r for r in rows}
    assert by_word["abcdef"][2] == "abcdefgh" and by_word[word][4] == 31
    assert found(spark, []) == found(spark, [(1, None)]) == found(spark, [(1, "short words on ly")]) == []


def test_long_text(spark):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcd") for _ in range(6)) for _ in range(200_000))
    n = plain_words([(1, text)])
    assert {(r[0], r[3]) for r in found(spark, [(1, text)])} == set(n.items())


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(3)
    for _ in range(500):
        at = sorted(rng.sample(range(12), rng.randint(3, 7)))
        cost = [rng.randint(1, 9) for _ in at]
        pairs = [(cost[i] + cost[j]) for i in range(len(at)) for j in range(i) if at[j] + 2 <= at[i]]
        i, j = P.pivots(cost, at)
        assert at[j] - at[i] >= 2 and cost[i] + cost[j] == min(pairs)
