"""Best-fit packing: the plan, the pieces' ids and places, and odd tables."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import DOCS, clashing, corpus, empty

from ledgerloom.llm import bpe, packing


def best_fit(lengths, sequence):
    """Document by document, from the longest down: the number of sequences."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(sequence - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_rank_once_and_equals_best_fit(seed):
    r = random.Random(seed)
    sequence = r.choice([7, 20, 64])
    lengths = [min(sequence, max(1, int(r.lognormvariate(1.5, 1)))) for _ in range(r.choice([3, 60, 400]))]
    filled, ranks = defaultdict(list), defaultdict(list)
    for length, rank, n, first, each, offset in packing.plan(Counter(lengths), sequence):
        for k in range(n):
            ranks[length].append(rank + k)
            filled[first + k // each].append((offset + k % each * length, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(lengths).items()}
    for held in filled.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= sequence
    assert len(filled) == best_fit(lengths, sequence)


def test_plan_does_not_grow_with_the_counts():
    some = {n: 3 + n % 5 for n in range(1, 200)}
    assert len(packing.plan({n: c * 10**9 for n, c in some.items()}, 256)) < 4 * len(packing.plan(some, 256))


def check(got, rows, sequence):
    library = bpe.Vocabulary(bpe.default_path()).library
    want = Counter()
    for d, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), sequence):
            part = ids[k:k + sequence]
            want[d, k // sequence, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist()
        assert sum(n for _, n in parts) <= sequence
    assert len(held) == best_fit([r.length for r in got], sequence)


@pytest.mark.parametrize("sequence", [2048, 50])
def test_pieces_hold_the_library_ids(spark, sequence):
    docs = spark.createDataFrame(corpus(), DOCS).repartition(5)
    got = packing.pack(clashing(docs), sequence=sequence).collect()
    check(got, [(r.doc_id, r.text) for r in docs.collect()], sequence)


def test_one_length_of_a_third_of_all_rows_and_repeated_ids(spark):
    rows = [(1, "one two", "en", "s", 0)] * 300 + [(None, "three", "en", "s", 0)] * 300 + [(k, "a b c " * (k % 40), "en", "s", 0) for k in range(300)]
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    check(packing.pack(docs, sequence=32).collect(), [(r[0], r[1]) for r in rows], 32)


def test_sequences_hold_their_pieces_in_order(spark):
    packed = packing.pack(spark.createDataFrame(corpus(), DOCS), sequence=100)
    pieces = defaultdict(list)
    for r in packed.collect():
        pieces[r.sequence_id].append((r.offset, r.doc_id, bytes(r.ids)))
    made = packing.sequences(packed).collect()
    assert len(made) == len(pieces)
    for r in made:
        assert bytes(r.ids) == b"".join(x for _, _, x in sorted(pieces[r.sequence_id]))
        assert r.n_tokens == len(r.ids) // 2 <= 100
        assert [(x["offset"], x["doc_id"]) for x in r.doc_ids] == [(o, d) for o, d, _ in sorted(pieces[r.sequence_id])]


def test_tables_without_rows_or_text(spark):
    assert packing.pack(empty(spark)).count() == 0
    got = packing.pack(spark.createDataFrame([(1, None, "en", "s", 0), (2, "", "en", "s", 0)], DOCS)).collect()
    assert sorted((r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in got) in ([(1, 0, 1, 0, 0), (2, 0, 1, 0, 1)], [(1, 0, 1, 0, 1), (2, 0, 1, 0, 0)])
