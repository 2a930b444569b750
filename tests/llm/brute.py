"""Plain Python versions and small fixtures that the tests of the training-data
operators share."""

import random
import re

from xxhash import xxh64_intdigest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=7, n=60):
    """Texts over a small vocabulary, with copies, near copies, a shared
    passage, null, empty, blank and odd ones."""
    r = random.Random(seed)
    words = ["Alpha", "beta", "gamma,", "delta.", "épsilon", "zeta", "Ärger", "λόγος", "日本", "x1", "don't", " nb", "<s>"]
    words += ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(80)]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 160))) for _ in range(n)]
    passage = " ".join(r.choice(words) for _ in range(70))
    texts += [t + "\n" + passage for t in texts[:9]]
    texts += [texts[3]] * 4 + [texts[5] + " end"] + [None, "", " \t\n", "a", "a b", "A  B\tc", "q" * 5000]
    texts += [" ".join(r.choice(words) for _ in range(6000))]
    return [(i, t, "en", f"src{i % 4}" if i % 11 else None, len(t or "")) for i, t in enumerate(texts)]


def empty(spark, schema=DOCS):
    return spark.createDataFrame([], schema)


def clashing(df):
    """Extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(9) for c in ("fp", "size", "h", "part", "m", "d", "th", "ids", "cls", "role", "turn", "_src", "_id", "y", "site", "page", "lines", "node", "root", "w", "tile") if c not in df.columns})


def split(text):
    return WORD.findall(text or "")


def simhash_brute(rows, radius=2):
    fps = []
    for _, t in rows:
        w = split("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hs = [xxh64_intdigest(g.encode(), 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    return {(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, component_ids([i for i, _ in rows], fps, radius))}


def component_ids(ids, fps, radius):
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for a, i in enumerate(ids):
        least[find(a)] = min(i, least.get(find(a), i))
    return [least[find(a)] for a in range(len(ids))]


def mix_brute(rows, weights=(1, 2, 3), cap=3.0):
    size = [len(split(t)) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    per = {s: sum(z for z, r in zip(size, rows) if r[2] == s) for s in names}
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, open_ = {}, float(sum(size)), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if cap * per[s] < w[s] * level}
        if not over:
            target |= {s: w[s] * level for s in open_}
            break
        for s in over:
            target[s] = cap * per[s]
            left -= target[s]
        open_ -= over
    return per, target
