"""Cross-tokenizer alignment against both libraries on whole texts."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from brute import DOCS, clashing, corpus, empty
from tokenizers import Tokenizer

from ledgerloom.llm import alignment, pieces


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(alignment.a_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.b_path())


def tokens(both, text):
    """Ids and bytes of both tokenizers' tokens of a whole text."""
    a, b = both
    unmap = {c: i for i, c in enumerate(pieces.byte_chars())}
    out = [[(i, bytes(unmap[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]]
    out.append([(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)])
    whole = (" " + text).encode()
    return out if all(b"".join(x for _, x in side) == whole for side in out) and text else [[], []]


def groups_of(both, text):
    """Cut wherever tokens of both end."""
    left, right = tokens(both, text)
    ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (left, right)]
    out, i, j = [], 0, 0
    for stop in sorted(set(ends[0]) & set(ends[1])):
        a, b = ends[0].index(stop, i) + 1, ends[1].index(stop, j) + 1
        out.append(([x for x, _ in left[i:a]], [x for x, _ in right[j:b]]))
        i, j = a, b
    return out


def brute(both, rows):
    groups = [groups_of(both, t or "") for _, t in rows]
    links = [[(a, b) for left, right in g for a in left for b in right] for g in groups]
    count = Counter(p for ls in links for p in set(ls))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (d, _), g, ls in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(ls), sum(count[p] == top[p[0]] for p in ls),
                    sum(count[p] for p in ls), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return Counter(out), count, top


def odd_texts(n=150):
    r = random.Random(4)
    letters = "abAB éÉßſİıΣςǅ̈Å½²٣Ⅷ'’\n\t\x0b\x1c\u0085  　  .!<|>0_-😀日本à…"
    out = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(n)]
    out += ["<|endoftext|> x <s> </s> <unk><0x0A>", "a▁b", "▁", " ", "   ", "a ", "a  ", " a", "\n", "x" * 3000, "日本" * 500, "ab" * 900 + " " * 70 + "c", "tab\t x", "nul\0 x"]
    return [(k, t, "en", "s", 0) for k, t in enumerate(out)]


@pytest.mark.parametrize("size", [alignment.BLOCK, 2_000])
def test_alignment_equals_whole_texts(spark, both, size):
    rows = corpus(n=30) + [(1000 + d, *x) for d, *x in odd_texts()] + [(None, "null id", "en", "s", 0), (3, "the same id", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    made, pairs = alignment.align(clashing(docs).drop("n"), size=size)
    want, count, top = brute(both, [(r[0], r[1]) for r in rows])
    assert Counter(map(tuple, made.collect())) == want
    assert {(r.a, r.b): (r.n, r.best) for r in pairs.collect()} == {p: (n, n == top[p[0]]) for p, n in count.items()}


def test_terminals_are_the_last_tokens_of_components():
    r = random.Random(1)
    for _ in range(200):
        whole = r.randint(1, 30)
        a, b = (np.array(sorted({whole, *r.sample(range(1, whole + 1), r.randint(0, whole))})) for _ in range(2))
        got = alignment.terminals(a, b)
        want = [int(np.searchsorted(b, min(x for x in set(a) & set(b) if x >= e))) for e in [*a, *b]]
        assert got.tolist() == want


def test_hot_texts_and_tables_without_tokens(spark, both):
    rows = [(1, "to be or not to be", "en", "s", 0)] * 200 + [(2, "not to be", "en", "s", 0)] * 5 + [(3, None, "en", "s", 0), (4, "", "en", "s", 0)]
    made, _ = alignment.align(spark.createDataFrame(rows, DOCS).repartition(4), size=100)
    assert Counter(map(tuple, made.collect())) == brute(both, [(r[0], r[1]) for r in rows])[0]
    assert alignment.align(empty(spark))[0].count() == 0
    none, pairs = alignment.align(spark.createDataFrame([(1, None, "en", "s", 0), (2, "▁", "en", "s", 0)], DOCS))
    assert sorted(map(tuple, none.collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")] and pairs.count() == 0


def test_a_block_is_aligned_in_bounded_parts(both, monkeypatch):
    """The same block whole and in parts: equal results, and the arrays that
    a worker holds at once are a fraction."""
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 9))) for _ in range(60_000)]
    texts = pa.array([" ".join(r.choices(words, k=200)) for _ in range(600)] + ["", None, "x" * 500])
    texts = texts.fill_null("")
    ids, aligner = pa.array(range(len(texts))), alignment._aligner(alignment.a_path(), alignment.b_path())
    seen = {}
    for parts, at_once in ((1 << 40, 1 << 40), (1 << 12, 1 << 13)):
        monkeypatch.setattr(alignment, "PARTS", parts)
        monkeypatch.setattr(alignment, "AT_ONCE", at_once)
        tracemalloc.start()
        docs, key, n, links = alignment._block(aligner, ids, texts)
        seen[parts] = tracemalloc.get_traced_memory()[1], [x.to_pylist() for x in docs], key.tolist(), n.tolist(), links
        tracemalloc.stop()
    (whole, *want), (part, *got) = seen.values()
    assert got == want
    assert part < 0.6 * whole, (part, whole)
