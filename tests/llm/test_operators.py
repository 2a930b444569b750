"""Operators of the training-data pipeline against brute force, on small
fixtures with nulls, empty and long texts, ties, repeated rows, hot groups,
empty tables and extra columns with clashing names."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import DOCS, clashing, component_ids, corpus, empty, mix_brute, simhash_brute, split

from ledgerloom.llm import ann, binary_ids, bpe, chat, fingerprints, line_dedup, mixing, simhash, superkmer, toxicity


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


def test_simhash_equals_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {tuple(r) for r in simhash.near_duplicates(clashing(docs)).collect()}
    assert got == simhash_brute(rows)


@pytest.mark.parametrize("block", [3, 8192])
def test_simhash_links_of_dense_groups_in_small_blocks(spark, block):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = {b ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for b in base for _ in range(12)} | set(base)
    # A chain: each link flips two further bits.
    chain, x = [], r.getrandbits(64)
    for k in range(0, 40, 2):
        x ^= 3 << k
        chain.append(x)
    fps = sorted(fps | set(chain))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    from ledgerloom.llm.components import components

    root = {x.node: x.root for x in components(simhash.links(df, 2, block)).collect()}
    got = [root.get(s, s) for s in signed]
    want = component_ids(signed, fps, 2)
    assert got == want
    assert simhash.links(df, 2, block).count() <= 42 * len(fps) * (1 if block > 3 else 20)


def test_one_of_each_keeps_one_row_per_component(spark):
    a, b = "one two three four five six " * 9, "seven eight nine ten eleven twelve " * 9
    rows = [(3, a, "en", "s", 1), (1, a, "en", "s", 1), (1, a, "en", "s", 1), (2, b, "en", "s", 1), (None, b, "en", "s", 1)]
    got = sorted(((r.doc_id or 0) for r in simhash.one_of_each(spark.createDataFrame(rows, DOCS)).collect()))
    assert got == [1, 2]
    assert simhash.one_of_each(empty(spark)).count() == 0 and simhash.near_duplicates(empty(spark)).count() == 0


def test_one_of_each_loses_no_unrelated_text_under_a_repeated_id(spark):
    r = random.Random(1)
    texts = [" ".join("".join(r.choice("abcdef") for _ in range(5)) for _ in range(30)) for _ in range(12)]
    rows = [(1, texts[0], "en", "s", 1), (1, texts[1], "en", "s", 1), (2, texts[0], "en", "s", 1), (2, texts[2], "en", None, 1), (2, texts[2], "en", "s", None)]
    rows += [(7, t, "en", "s", 1) for t in texts] + [(None, t, "en", "s", 1) for t in texts[:6]] + [(None, "only unnamed " * 9, "en", "s", 1)] * 3
    got = simhash.one_of_each(clashing(spark.createDataFrame(rows, DOCS)).drop("ids")).collect()
    kept = sorted((x.text, x.doc_id) for x in got)
    least = {}
    for i, t, *_ in rows:
        least[t] = min(least.get(t, 99), 99 if i is None else i)
    assert kept == sorted((t, None if i == 99 else i) for t, i in least.items())


# ----------------------------------------------------------- fingerprints
def test_fingerprints_edit_order_and_equal_texts(spark, docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.compare(clashing(docs)).collect()}
    assert len(got) == len(rows)
    rank = fingerprints.ranks(fingerprints.entropy_counts(docs))
    seen = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        changed = t[:len(t) - n] + following[:n]
        own, after, other = (fingerprints.fingerprint([x], rank)[0] for x in (t, following, changed))
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == fingerprints.as_text(own) and r.edited_fingerprint == fingerprints.as_text(other)
        assert r.near_edited == fingerprints.likeness(own, other) and r.near_next == fingerprints.likeness(own, after)
        assert 0 <= r.near_edited <= 1 and seen.setdefault(t, r.fingerprint) == r.fingerprint
        assert np.array_equal(fingerprints.from_text(r.fingerprint), own)
    long = [r for r in got.values() if r.n_chars > 400]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.2


def test_fingerprint_edge_tables(spark):
    assert fingerprints.compare(empty(spark)).count() == 0
    one = fingerprints.compare(spark.createDataFrame([(5, "abc" * 90, "en", "s", 1)], DOCS)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    odd = [(None, "x" * 300, "en", "s", 1), (2, None, "en", "s", 1), (2, "b" * 70, "en", "s", 1), (None, "", "en", "s", 1)]
    assert fingerprints.compare(spark.createDataFrame(odd, DOCS)).count() == 4


def fingerprint_brute(texts, corpus_texts, window=16, popular=2, weak=100):
    """Bits of each text's filters, window by window in plain Python."""
    from collections import Counter

    import math

    from xxhash import xxh3_64_intdigest

    def entropies(raw):
        clog = lambda c: round(c * math.log2(c) * 2**32) if c else 0
        full = clog(window)
        parts = [raw[i:i + window] for i in range(len(raw) - window + 1)]
        return [1000 * ((full - sum(clog(c) for c in Counter(p).values())) >> 16) // (full >> 16) for p in parts]

    seen = Counter(e for t in corpus_texts for e in entropies((t or "").encode()))
    rank = {e: k for k, e in enumerate(sorted(range(weak, 1001), key=lambda e: (seen[e], -e)))}
    out = []
    for t in texts:
        raw = (t or "").encode()
        es = entropies(raw)
        wins = Counter()
        # Every stretch of neighbouring windows, those over the ends included.
        for at in range(1 - window, len(es)):
            near = [(rank[es[i]], i) for i in range(max(0, at), min(len(es), at + window)) if es[i] in rank]
            if near:
                wins[min(near)[1]] += 1
        own = [raw[i:i + window] for i in sorted(wins) if wins[i] >= popular] or ([raw[:window]] if raw else [])
        own = list(dict.fromkeys(own))
        filters = []
        for k in range(0, len(own), 160):
            h = [xxh3_64_intdigest(f) for f in own[k:k + 160]]
            filters.append({x >> 11 * j & 2047 for x in h for j in range(5)})
        out.append(filters)
    return out


def likeness_brute(a, b):
    if not a or not b:
        return float(a == b)
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for x in a:
        best = 0.0
        for y in b:
            chance, most = len(x) * len(y) / 2048, min(len(x), len(y))
            best = max(best, min(1.0, max(0.0, (len(x & y) - chance) / max(most - chance, 1e-9))))
        total += best * len(x)
    return total / sum(map(len, a))


def test_fingerprints_equal_a_plain_version(spark):
    r = random.Random(6)
    texts = [" ".join("".join(r.choice("abcdeé日") for _ in range(r.randint(1, 9))) for _ in range(r.randint(0, 90))) for _ in range(25)]
    texts += [None, "", "x", "aaaa" * 20, "z" * 15, "exactly16 bytes!"]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    got = {x.doc_id: x for x in fingerprints.compare(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    order = list(range(len(texts) - 1, -1, -1))
    after = {i: order[(k + 1) % len(order)] for k, i in enumerate(order)}
    plain = [t or "" for t in texts]
    changed = [t[:len(t) - len(t) // 3] + plain[after[i]][:len(t) // 3] for i, t in enumerate(plain)]
    own, other = fingerprint_brute(plain, plain), fingerprint_brute(changed, plain)
    for i in range(len(texts)):
        for text, filters in ((got[i].fingerprint, own[i]), (got[i].edited_fingerprint, other[i])):
            bits = np.unpackbits(fingerprints.from_text(text), axis=1)
            assert [set(np.flatnonzero(b).tolist()) for b in bits] == filters
        assert abs(got[i].near_edited - likeness_brute(own[i], other[i])) < 1e-12
        assert abs(got[i].near_next - likeness_brute(own[i], own[after[i]])) < 1e-12
        assert got[i].edited_sha256 == hashlib.sha256(changed[i].encode()).hexdigest() and got[i].n_chars == len(plain[i])


def test_a_text_stays_near_its_shortened_copy():
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    texts = []
    for n in range(100, 2000, 10):
        t = " ".join(r.choice(words) for _ in range(n))
        texts.append(t[:n])
    counts = np.zeros(1001, np.int64)
    for t in texts:
        for e in fingerprints._scores(np.frombuffer(t.encode(), np.uint8)):
            counts[e] += 1
    rank = fingerprints.ranks(counts)
    own = fingerprints.fingerprint(texts, rank)
    less = fingerprints.fingerprint([t[:len(t) - len(t) // 3] for t in texts], rank)
    assert min(fingerprints.likeness(a, b) for a, b in zip(own, less)) >= 0.6
    assert max(fingerprints.likeness(a, b) for a, b in zip(own, own[7:])) < 0.5


def test_entropy_is_that_of_each_window():
    raw = np.frombuffer("aaa bbb the quick brown fox é".encode() * 8, np.uint8)
    for s, score in enumerate(fingerprints._scores(raw)):
        p = np.unique(raw[s:s + fingerprints.WINDOW], return_counts=True)[1] / fingerprints.WINDOW
        assert abs(score - 1000 * -(p * np.log2(p)).sum() / np.log2(fingerprints.WINDOW)) < 1.01


# ------------------------------------------------------------- binary ids
def test_pfor_blocks_and_files_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 4096):
        for top in (1, 3, 200, 49408, 1 << 32):
            v = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            v[rng.integers(n)] = (1 << 32) - 1
            assert np.array_equal(binary_ids.unpack_block(binary_ids.pack_block(v), n), v)
    held = [(i if i % 5 else None, rng.integers(0, 50_000, rng.integers(0, 900)).astype(np.uint32)) for i in range(60)]
    file = binary_ids.TokenFile(binary_ids.pack_file(held, block=128))
    assert [(d, i.tolist()) for d, _, i in file.documents()] == [(d, i.tolist()) for d, i in held]
    whole = np.concatenate([i for _, i in held])
    assert np.array_equal(file.ids(1000, 3000), whole[1000:3000])


def test_token_files_hold_the_library_ids_in_order(spark, docs, tmp_path):
    out = str(tmp_path / "ids")
    binary_ids.write_ids(clashing(docs).drop("ids"), out, file_tokens=500)
    assert spark.read.parquet(out).count() > 5
    got = {r.doc_id: tuple(r)[1:] for r in binary_ids.read_ids(spark, out).collect()}
    library, at, want = bpe.Vocabulary(bpe.default_path()).library, 0, {}
    for i, t in sorted((r.doc_id, r.text) for r in docs.collect()):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[i] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want


def test_token_files_of_odd_tables(spark, tmp_path):
    rows = [(None, "b", "en", "s", 1), (4, "a", "en", "s", 1), (4, "a", "en", "s", 1), (1, None, "en", "s", 1)]
    binary_ids.write_ids(spark.createDataFrame(rows, DOCS), str(tmp_path / "a"))
    got = sorted((r.start, r.doc_id) for r in binary_ids.read_ids(spark, str(tmp_path / "a")).collect())
    assert got == [(0, 1), (1, 4), (3, 4), (5, None)]
    binary_ids.write_ids(empty(spark), str(tmp_path / "b"))
    assert binary_ids.read_ids(spark, str(tmp_path / "b")).count() == 0


def test_mixing_reaches_targets_within_a_document(docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    per, target = mix_brute(rows)
    got = mixing.plan(clashing(docs)).collect()
    assert len(got) == len(rows)
    again = {(r.doc_id, r.taken) for r in mixing.plan(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    size = {i: len(split(t)) for i, t, _ in rows}
    for s in per:
        mine = [r for r in got if r.source == s]
        assert all(r.size == size[r.doc_id] and r.taken <= 3 * r.size and r.source_size == per[s] for r in mine)
        assert all(abs(r.target - target[s]) < 1e-6 * max(1, target[s]) for r in mine)
        base = int(target[s] // per[s]) if per[s] else 0
        ordered = sorted(mine, key=lambda r: int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16))
        extra = [r.taken - base * r.size for r in ordered]
        first = next((k for k, e in enumerate(extra) if e != ordered[k].size), len(extra))
        assert not any(extra[first:])  # a prefix of the hash order
        near = max((r.size for r in mine), default=0) / 2
        assert abs(sum(r.taken for r in mine) - target[s]) <= near + 1e-6


def test_mix_repeats_whole_rows(docs):
    wide = clashing(docs)
    taken = {r.doc_id: r.copies for r in mixing.plan(docs).collect()}
    out = mixing.mix(wide)
    assert out.columns == wide.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in taken.items() if n}


def test_mixing_edges(spark):
    assert mixing.plan(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    blank = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (None, "w w", "en", "a", 0)]
    got = {r.doc_id: (r.size, r.taken) for r in mixing.plan(spark.createDataFrame(blank, DOCS)).collect()}
    assert got[1] == (0, 0) and got[2] == (0, 0) and got[None][0] == 2


# --------------------------------------------------------------- toxicity
def test_composed_automaton_reads_clauses():
    g = toxicity.Grammar({"idiot": 1.0}, {"scum": 0.5})

    def classes(text):
        return {toxicity.CLASSES[k] for k in np.flatnonzero(g.clauses(text))}

    assert classes("A plain text, nothing here.") == set()
    assert classes("You idiot!") == {(1, 0, 1, 0, 0)}
    assert classes("not an idiot, he said") == {(1, 0, 0, 1, 0)}
    assert classes("She said: you idiot, go.") == {(1, 0, 1, 0, 1)}
    assert classes("They will kill them. scummy") == {(0, 1, 1, 0, 0), (1, 0, 0, 0, 0)}
    plain, negated, reported = (g.score(t) for t in ("you idiot", "not an idiot", "he said idiot"))
    assert plain > negated and plain > reported > g.score("nothing") == g.score(None) == g.score("")


def toxic_rows(n=600):
    r = random.Random(11)
    words = ["".join(r.choice("abcdefghij") for _ in range(4)) for _ in range(300)]
    rows = []
    for i in range(n):
        w = [r.choice(words) for _ in range(30)]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                w.insert(r.randrange(len(w)), r.choice(["blarg", "snork", "xyzzy" + r.choice(words)]))
        rows.append((i, " ".join(w), "en", "s", 0, int(bad)))
    return rows


def test_toxicity_learns_from_rows_outside_the_held_out_part(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([r[:5] for r in rows] + [(None, None, "en", "s", 0), (9_000, "", "en", "s", 0)], DOCS)
    labels = spark.createDataFrame([(r[0], 1, r[5]) for r in rows], "doc_id long, quality int, toxic int")
    grammar = toxicity.fit(docs, labels)
    assert {"blarg", "snork"} <= set(grammar.words) and any(s.startswith("xyzz") for s in grammar.stems)
    kept = {r.doc_id for r in toxicity.clean(clashing(docs), labels).collect()}
    held = {r.doc_id for r in docs.where(toxicity.held_out(docs["doc_id"])).collect() if r.doc_id is not None}
    assert held == {i for i in [*range(600), 9_000] if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [(i in kept) == (not y) for i, *_, y in rows if i in held]
    assert np.mean(right) > 0.95 and None in kept and 9_000 in kept


def test_toxicity_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "hello there", "en", "s", 0), (2, None, "en", "s", 0)], DOCS)
    assert toxicity.clean(docs, labels).count() == 2
    assert toxicity.clean(empty(spark), labels).count() == 0


# -------------------------------------------------------------------- bpe
def test_bpe_equals_the_library(docs):
    library = bpe.Vocabulary(bpe.default_path()).library
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    got = bpe.encode(clashing(docs).drop("ids"), words=50).collect()
    assert len(got) == len(text)
    for r in got:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    sums = {r.doc_id: r for r in bpe.digests(docs, words=50).collect()}
    for r in got:
        assert sums[r.doc_id].n_tokens == len(r.ids) // 4 and sums[r.doc_id].ids_sha256 == hashlib.sha256(r.ids).hexdigest()


@pytest.mark.parametrize("kind", [lambda: bpe.Encoder(bpe.default_path(), bpe.Lexicon.compile([])), lambda: binary_ids._Library(bpe.default_path())])
def test_bpe_odd_characters(kind, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 300)
    v = bpe.Vocabulary(bpe.default_path())
    encoder = kind()
    r = random.Random(2)
    letters = "abAB éÉßſİıΣςǅǺ̈Å½²٣Ⅷ'’\n\t\x0b\x1c\u0085  .!<|>0_-😀日"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(1500)]
    texts += ["<|startoftext|>a<|endoftext|>", "<<|endoftext|>>", "x" * 20_000, "ab'll've''s", "<|STARTOFTEXT|>", "İ İžb Straße. Ÿ, Àb. a.' don't.", "Word word, WORD. wörd; WÖRD!?"]
    for t, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == v.library.encode(t, add_special_tokens=False).ids, t


def test_lexicon_is_minimal_and_exact(tmp_path):
    r = random.Random(5)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 7))) + r.choice(["ing", "ed", ""]) for _ in range(400)})
    entries = [(w.encode(), [k, k + 1][: 1 + k % 2]) for k, w in enumerate(words)]
    lexicon = bpe.Lexicon.compile(entries)
    lexicon.save(str(tmp_path / "x"))
    lexicon = bpe.Lexicon.open(str(tmp_path / "x"))
    numbers = lexicon.find([w for w, _ in entries])
    for (w, ids), k in zip(entries, numbers):
        assert lexicon.ids[lexicon.starts[k]:lexicon.starts[k + 1]].tolist() == ids
    assert (lexicon.find([b"zzz", b"abcabcabcabcabc", b"ing" * 9]) == -1).all()
    # Minimal: no two states have the same finality and transitions with the same futures.
    states = len(lexicon.final)
    out = {s: (int(lexicon.final[s]), []) for s in range(states)}
    for key, t in zip(lexicon.keys, lexicon.target):
        out[int(key) // 256][1].append((int(key) % 256, int(t)))
    assert len({(f, tuple(e)) for f, e in out.values()}) == states
    assert isinstance(lexicon.keys.base, np.memmap) or isinstance(lexicon.keys, np.memmap)


def test_bpe_empty_table(spark):
    assert bpe.digests(empty(spark)).count() == 0


# ------------------------------------------------------------ super-k-mers
def windows_brute(rows, window):
    first, words = {}, {}
    for i, t in sorted(rows):
        words[i] = split(t)
        for j in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][j:j + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < i:
                gone |= set(range(j, j + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot, window, size", [(2_000, 50, 8), (0, 50, 8), (2, 12, 3), (2_000, 5, 5)])
def test_repeated_windows_equal_brute_force(docs, hot, window, size, monkeypatch):
    monkeypatch.setattr(superkmer, "STRETCH", 97)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: tuple(r)[1:] for r in superkmer.digests(clashing(docs), window=window, size=size, hot=hot).collect()}
    assert got == windows_brute(rows, window)
    assert any(v[1] for v in got.values())


def test_super_kmers_cover_every_window_once():
    words = [w.encode() for w in split(corpus()[-1][1])]
    first, n, m = superkmer.super_kmers(words)
    assert first[0] == 0 and (first[1:] == first[:-1] + n[:-1]).all() and first[-1] + n[-1] == len(words) - 49
    again = superkmer.super_kmers(words[100:])
    at = dict(zip(*[x.tolist() for x in (np.repeat(first, n) + np.concatenate([np.arange(k) for k in n]), np.repeat(m, n))]))
    own = np.repeat(again[0], again[1]) + np.concatenate([np.arange(k) for k in again[1]])
    assert all(at[w + 100] == x for w, x in zip(own.tolist(), np.repeat(again[2], again[1]).tolist()))


def test_repeated_ids_are_one_document(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text, "en", "s", 0), (1, text, "en", "s", 0), (None, text, "en", "s", 0), (2, "short", "en", "s", 0)]
    got = sorted(((r.doc_id or 99), r.n_removed) for r in superkmer.digests(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(1, 0), (1, 0), (2, 0), (99, 60)]
    kept = {r.doc_id: r.text for r in superkmer.clean(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == {1: text, 2: "short", None: ""}
    assert superkmer.digests(empty(spark)).count() == 0


# ------------------------------------------------------------- line dedup
def test_boilerplate_lines_go_and_copies_count_once(spark):
    rows = []
    for i in range(40):
        rows.append((i, f"own line {i}\n  footer of a \nmore {i * i}\n\n{'x' if i % 2 else 'y'}", "en", "a", 0))
    rows += [(100 + i, "copied page\nits second line", "en", "a", 0) for i in range(30)]
    rows += [(200 + i, f"footer of a\nother {i}", "en", "b", 0) for i in range(3)]
    rows += [(300, None, "en", "a", 0), (301, "", "en", None, 0), (302, "footer of a", "en", None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = line_dedup.drop_boilerplate(clashing(docs).drop("lines"), ratio=0.3)
    got = {r.doc_id: (r.text, r["__lines"], r["__dropped"]) for r in out.collect()}
    assert len(got) == len(rows)
    assert got[4] == ("own line 4\nmore 16\n", 5, 2)  # footer and the line "y" of half the pages
    assert got[100][0] == "copied page\nits second line"
    assert got[200][0] == "other 0"  # another host, all of its three pages
    assert got[300] == (None, 0, 0) and got[301][0] == "" and got[302][0] == "footer of a"
    assert line_dedup.drop_boilerplate(empty(spark)).count() == 0


def test_html_lines_and_hosts(spark):
    from pyspark.sql import functions as F

    html = '<html><head><style>p{}</style><script>var t="</p>";</script></head><body><p>One <b>bold</b> line<br>two</p><!-- x --><div class="a">three</div>\n \n</body></html>'
    row = spark.createDataFrame([(html, "HTTP://u@Www.Example.org:80/p?q"), (None, None), ("", "no url")], "html string, url string")
    got = row.select(line_dedup.html_lines(F.col("html")), line_dedup.host_of(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [("One bold line\ntwo\nthree", "www.example.org"), (None, None), ("", None)]


# ------------------------------------------------------------------- chat
CHAT = "conv_id long, turn long, role string, text string"


def test_chat_round_trip_masks_and_hot_conversations(spark):
    r = random.Random(4)
    pieces = ["hi", "</s>", "[INST]", "[/INST]", "<s>", "␛0", "␛", "[ROLE]", "[TEXT]", "<|endoftext|>", " ", "\n", "é日😀", "<", "[", "s>"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "[ROLE]x", None]), r.choice([None, "", "".join(r.choice(pieces) for _ in range(12))]))
            for c in range(25) for t in range(r.randint(1, 8))]
    rows += [(77, t, ["user", "assistant"][t % 2], f"turn {t} [INST]") for t in range(700)]  # a hot conversation
    rows += [(78, 0, "assistant", "same"), (78, 0, "assistant", "same"), (78, None, "user", "last"), (None, 0, "user", "x")]
    df = spark.createDataFrame(rows, CHAT).repartition(4)
    got = {x.conv_id: x for x in chat.read_back(chat.format_conversations(clashing(df).drop("w"), block_turns=64)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t if t is not None else 1 << 60, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        g = got[c]
        assert g.n_turns == len(turns)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in turns).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(empty(spark, CHAT))).count() == 0


def test_masked_tokens_are_those_of_assistant_texts():
    t = chat.Template(chat.default_path())
    turns = [("user", " ask "), ("assistant", " yes, é日"), ("assistant", ""), ("system", "s"), ("assistant", "</s>[INST] ok [/INST]")]
    formatted, spans = t.render(turns)
    ids, offsets, mask = t.encode(formatted, spans)
    for (a, b), on in zip(offsets.tolist(), mask.tolist()):
        assert on == any(a < hi and b > lo for lo, hi in spans)
        assert not on or any(lo <= a and b <= hi for lo, hi in spans)  # no token reaches over an edge
    assert t.read(formatted) == turns
    assert t.learnt(formatted, offsets, mask) == " yes, é日</s>[INST] ok [/INST]"


# -------------------------------------------------------------------- ann
VEC = "vec_id long, embedding array<float>, label int"


def ann_brute(rows, k=10):
    good = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in [i for i in good if i % 100 == 0]:
        d = sorted((float(np.sqrt(((good[q] - x) ** 2).sum())), i) for i, x in good.items() if i != q)
        out[q] = d[:k]
    return out


def test_neighbours_recall_scores_and_hot_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[200:700] = x[200]  # a third of all rows are one vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(3000, None), (3100, [0.0] * 24), (3200, [float("nan")] * 24), (3300, [1.0, None] + [0.0] * 22), (3400, [1.0] * 7)]
    df = clashing(spark.createDataFrame([(i, v, 0) for i, v in rows], VEC).repartition(6))
    got = {}
    for r in ann.search(df, lambda i: i % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    want = ann_brute([r for r in rows if r[0] != 3400])
    assert set(got) == set(want)
    hits = 0
    for q, near in got.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, 11)) and [(s, v) for _, s, v in near] == sorted((s, v) for _, s, v in near)
        exact = {i: d for d, i in ann_brute(rows[:1500], 10_000)[q]} if q in (0, 300) else {}
        assert all(exact[v] == s for _, s, v in near if exact)
        hits += len({v for _, _, v in near} & {i for _, i in want[q]})
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [v for _, _, v in got[300]] == [i for _, i in want[300]]  # ties go to the smaller id


def test_neighbours_of_few_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (5, [0.0, 100.0], 0), (100, [-900.0, 3.0], 0)], VEC)
    got = sorted(tuple(r)[:3] for r in ann.search(few, lambda i: i % 100 == 0).collect())
    assert got == [(0, 1, 5), (0, 2, 100), (100, 1, 0), (100, 2, 5)]
    assert ann.search(few.limit(0), lambda i: i % 100 == 0).count() == 0


def test_neighbours_of_mixed_densities(spark):
    """Recall of each density group, with r fitted on the larger one."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6000, 32))
    dense = rng.random(6000) < 0.6
    x[dense] *= 0.33
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VEC).repartition(6)
    got = {}
    for r in ann.search(df, lambda i: i % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = ann_brute(rows)
    for group in (dense, ~dense):
        of = [q for q in want if group[q]]
        assert sum(len(got[q] & {i for _, i in want[q]}) for q in of) >= 0.95 * 10 * len(of)


# ------------------------------------------------------------- components
def test_mark_of_many_edges(spark):
    """More than 2^24 edges, where a sum of 40-bit hashes passes a long."""
    from pyspark.sql import functions as F

    from ledgerloom.llm.components import _mark

    many = spark.range((1 << 24) + (1 << 22)).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    mark = _mark(many)
    assert mark[0] == (1 << 24) + (1 << 22)
    assert mark != _mark(many.withColumn("v", F.when(F.col("u") == 7, 9).otherwise(F.col("v"))))


def test_periodic_texts_and_copies_under_one_id(spark):
    """One word over and over, in texts of many lengths (one super-k-mer of
    thousands of equal windows), and a thousand rows of one id and text."""
    r = random.Random(8)
    periodic = [(k, "ab " * r.randint(40, 900), "en", "s", 0) for k in range(60)]
    periodic += [(100 + k, "one two " * r.randint(20, 400), "en", "s", 0) for k in range(20)]
    copies = [(500, " ".join(f"c{k}" for k in range(80)), "en", "s", 0)] * 1000 + [(501, " ".join(f"c{k}" for k in range(10, 80)), "en", "s", 0)]
    rows = periodic + copies
    want = windows_brute([(r[0], r[1]) for r in rows], 50)
    for hot in (superkmer.HOT, 300):
        got = superkmer.digests(spark.createDataFrame(rows, DOCS).repartition(6), hot=hot).collect()
        assert len(got) == len(rows) and {x.doc_id: tuple(x)[1:] for x in got} == want
