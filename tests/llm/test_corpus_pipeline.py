"""The corpus pipeline against a plain Python version of every stage."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import bpe, line_dedup, toxicity
from brute import mix_brute, simhash_brute, split


def toxicity_brute(spark, docs, sf):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    grammar = toxicity.fit(frame.select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet"))
    return [d for d in docs if grammar.score(d["text"]) < 0.5]


def lines_brute(docs):
    pages, held = defaultdict(set), defaultdict(set)
    for d in docs:
        pages[d["source"]].add(d["text"])
        for x in {x.strip(" \t\r\x0b\x0c") for x in d["text"].split("\n")} - {""}:
            held[d["source"], x].add(d["text"])
    often = {k for k, v in held.items() if len(v) - 1 > line_dedup.RATIO * (len(pages[k[0]]) - 1)}
    out = []
    for d in docs:
        text = "\n".join(x for x in d["text"].split("\n") if (d["source"], x.strip(" \t\r\x0b\x0c")) not in often)
        out.append(d | {"text": text, "n_chars": len(text)})
    return out


def near_brute(docs):
    names = {i: c for i, _, c in simhash_brute([(d["doc_id"], d["text"]) for d in docs])}
    return [d for d in docs if names[d["doc_id"]] == d["doc_id"]]


def mixed_brute(docs):
    rows = [(d["doc_id"], d["text"], d["source"]) for d in docs]
    per, target = mix_brute(rows)
    out = []
    for s in per:
        mine = sorted((d for d in docs if d["source"] == s), key=lambda d: int(hashlib.md5(str(d["doc_id"]).encode()).hexdigest()[:15], 16))
        base = int(target[s] // per[s]) if per[s] else 0
        rest, before = target[s] - base * per[s], 0
        for d in mine:
            size = len(split(d["text"]))
            out += [d] * (base + (before + size / 2 <= rest))
            before += size
    return out


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    """Each stage's own rows, written and read again as on a cluster."""
    docs, out = spark.read.parquet(f"{sf_small}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small).checkpoint()
        out[name] = docs
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def counted(docs):
    return Counter(tuple(sorted(d.items(), key=lambda x: x[0])) for d in docs)


def test_stages_equal_their_plain_versions(spark, sf_small, stages):
    docs = rows(spark.read.parquet(f"{sf_small}/documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mixing", "bpe"]
    for name, brute in (("toxicity", lambda d: toxicity_brute(spark, d, sf_small)), ("line_dedup", lines_brute),
                        ("near_duplicates", near_brute), ("mixing", mixed_brute)):
        assert stages[name].columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = brute(docs)
        assert counted(docs) == counted(rows(stages[name])), name
        assert docs
    library = bpe.Vocabulary(bpe.default_path()).library
    want = Counter()
    for d in docs:
        ids = library.encode(d["text"], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in stages["bpe"].collect()) == want


def test_run_applies_the_stages_in_order(spark, sf_small, stages):
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, sf_small).collect())
    assert got == Counter(tuple(r) for r in stages["bpe"].collect())


def test_stages_take_odd_rows(spark, sf_small):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = [(1, None, "en", None, None), (2, "", "en", "s", 0), (3, "x" * 3000, None, "s", 3000), (3, "x" * 3000, None, "s", 3000), (None, "a b c", "en", "s", 5)]
    for data in (odd, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, sf_small).checkpoint()
        # Rows without words take no part in the mix; the others do.
        assert {r.doc_id for r in docs.collect()} <= {1, 2, 3, None}
    labels = f"{sf_small}/labels.parquet"
    assert spark.read.parquet(labels).count() > 0


@pytest.mark.parametrize("variants, others, more", [(5, 60, 0), (40, 496, 30)])
def test_near_copies_keep_the_lines_they_share(spark, sf_small, variants, others, more):
    """One-word variants of a 13-line text in a small and in a hot source;
    the footer that unlike pages share goes all the same."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    page = [" ".join(word() for _ in range(9)) for _ in range(13)]
    footer = ["the footer of every other page", "and its second line"]
    docs = []
    for i in range(variants):
        own = list(page)
        own[i % 13] = " ".join([word()] + own[i % 13].split()[1:])
        docs.append((i, "\n".join(own), "en", "a", 0))
    for i in range(others):
        own = [" ".join(word() for _ in range(9)) for _ in range(1 + i % 4)]
        docs.append((1000 + i, "\n".join(own + footer * (i % 2)), "en", "a", 0))
    docs += [(5000 + i, docs[0][1], "en", "a", 0) for i in range(more)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = {x.doc_id: x.text for x in corpus_pipeline._line_dedup(spark, frame, sf_small).collect()}
    assert got == {i: "\n".join(x for x in t.split("\n") if x not in footer) for i, t, *_ in docs}
