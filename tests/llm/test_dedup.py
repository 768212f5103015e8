import hashlib
import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tokenmill.llm import bwt_dedup, similar, simhash_gray
from tokenmill.llm.common import connected_components


def brute_fingerprint(text, shingle=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits):
    label = {fp: fp for fp in fps}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ordered = sorted(fps)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return {fp: find(fp) for fp in fps}


def near_set(rng, groups, copies, flips):
    out = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(copies):
            fp = base
            for bit in rng.sample(range(64), rng.randint(0, flips)):
                fp ^= 1 << bit
            out.add(fp)
    return out


def test_near_pairs_are_all_pairs():
    rng = random.Random(1)
    values = np.array(sorted(near_set(rng, 40, 60, 5)), np.uint64)
    for max_bits in (0, 4, 10):
        found = [(int(a), int(b), int(d)) for u, v, w in simhash_gray.near_pairs(values, max_bits) for a, b, d in zip(u, v, w)]
        bits = np.bitwise_count(values[:, None] ^ values[None, :])
        want = [(a, b, int(bits[a, b])) for a, b in zip(*np.nonzero(bits <= max_bits)) if a < b]
        assert sorted(found) == sorted((int(a), int(b), d) for a, b, d in want)


def test_links_are_the_same_for_any_node_size(spark):
    rng = random.Random(2)
    fps = near_set(rng, 12, 40, 4)
    signed = [(fp - (1 << 64) if fp >> 63 else fp,) for fp in fps]
    frame = spark.createDataFrame(signed, "fp bigint")
    want = brute_components(fps, 4)
    for node_size in (4096, 16):  # 16: nodes are divided, and divided ones are dealt into chunks
        roots = connected_components(simhash_gray.near_links(frame, 4, node_size)).collect()
        pairs = {(r.node % 2**64, r.root % 2**64) for r in roots}
        classes = {}
        for node, root in pairs:
            classes.setdefault(root, set()).add(node)
        wanted = {}
        for node, root in want.items():
            wanted.setdefault(root, set()).add(node)
        assert sorted(map(sorted, classes.values())) == sorted(sorted(v) for v in wanted.values() if len(v) > 1)


def test_near_duplicates_equal_brute_force(frame, documents, odd_rows):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(i and i + 10_000, t) for i, t in odd_rows]
    found = simhash_gray.near_duplicates(frame(rows)).collect()
    fps = {t: brute_fingerprint(t) for _, t in rows}
    roots = brute_components(set(fps.values()), 4)
    least = {}
    for i, t in rows:
        if i is not None:
            root = roots[fps[t]]
            least[root] = min(i, least.get(root, i))
    want = Counter((i, fps[t], least.get(roots[fps[t]])) for i, t in rows)
    assert Counter((r.doc_id, r.fp % 2**64, r.component) for r in found) == want


def test_near_duplicates_of_nothing(frame):
    assert simhash_gray.near_duplicates(frame([])).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    roots = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert roots == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}}


def test_similar_documents_need_like_texts(frame):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    changed = base.copy()
    changed[150] = "other"
    far = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(1, " ".join(base)), (2, " ".join(changed)), (3, " ".join(far)), (4, " ".join(base))]
    found = {r.doc_id: r.component for r in similar.similar_documents(frame(rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 1}


def shingle_set(text, k=5):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute_similar(rows, similarity=0.8):
    """(id, component) by every pair of sets."""
    sets = sorted({shingle_set(t) for _, t in rows}, key=sorted)
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    at = {s: top(i) for i, s in enumerate(sets)}
    ids = {}
    for i, t in rows:
        ids.setdefault(at[shingle_set(t)], []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return Counter((i, least[at[shingle_set(t)]]) for i, t in rows)


def families(rng, n):
    """Texts of a template with few or many words changed, so that near ones fail and far ones pass at 0.8."""
    rows = []
    for _ in range(n):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((60, 150, 400)))]
        for changes in (0, 1, 2, 3, 4, 5, 6, 7):
            words = base.copy()
            for at in rng.sample(range(len(base)), changes * len(base) // 150):
                words[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    return rows


def components(found):
    return Counter((r.doc_id, r.component) for r in found.collect())


def hide_behind_nearest(rng):
    """A text x, one y that is near by fingerprint and unlike, and a like z farther away, with one chance to be seen."""
    bits = lambda t: simhash_gray.majority(simhash_gray.shingle_hasher(5)(t)) % 2**64
    like = lambda a, b: len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b))
    while True:
        base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        changed = []
        for n in (3, 7):
            words = base.copy()
            for at in rng.sample(range(150), n):
                words[at] = f"x{rng.randrange(10**6)}"
            changed.append(" ".join(words))
        x, (z, y) = " ".join(base), changed
        if like(x, z) >= 0.8 > max(like(x, y), like(y, z)) and bits(x) ^ bits(y) and (bits(x) ^ bits(y)).bit_count() < (bits(x) ^ bits(z)).bit_count() <= 10:
            return x, y, z


def test_a_rejected_nearest_one_hides_nothing(frame):
    rng = random.Random(11)
    rows = [(i, t) for i, t in enumerate(t for _ in range(40) for t in hide_behind_nearest(rng))]
    assert components(similar.similar_documents(frame(rows))) == brute_similar(rows)


def test_similar_documents_equal_brute_force_for_any_node_size(frame, odd_rows):
    rng = random.Random(12)
    rows = families(rng, 25) + odd_rows[:-2]
    want = brute_similar(rows)
    for node_size, list_size in ((32_768, 4096), (16, 4)):  # small: nodes are divided, lists are dealt into chunks
        found = similar.similar_documents(frame(rows), max_bits=10, node_size=node_size, list_size=list_size)
        assert components(found) == want


def test_dealt_lists_bring_all_that_are_apart_together(spark):
    rng = random.Random(14)
    lists = [(1, s, 1, 500, 7 if s < 400 else s) for s in range(500)] + [(2, s, 1, 90, s) for s in range(90)]
    lists += [(3, s, 1, 30, s % 2) for s in range(30)] + [(4, s, 1, 200, rng.randrange(3)) for s in range(200)]
    found = spark.createDataFrame(lists, "node bigint, s bigint, at bigint, size bigint, label bigint")
    nodes = {}
    for r in similar.dealt_lists(found, 40).collect():
        nodes.setdefault(r.node, []).append((r.s, r.label))
    met = {frozenset((a, b)) for n in nodes.values() for a, la in n for b, lb in n if la != lb}
    want = {frozenset((a, b)) for node in (1, 2, 3, 4) for n, a, _, _, la in lists if n == node for m, b, _, _, lb in lists if m == node and la != lb}
    assert want <= met and max(map(len, nodes.values())) < 100
    assert sum(len([s for s, label in n if label == 7]) for n in nodes.values() if any(s >= 400 for s, _ in n)) <= 400 * 5


def test_one_fingerprint_is_not_one_text(frame):
    texts = ["a " * 100 + " ".join(f"{salt}{i}" for i in range(20)) for salt in "bcc"]
    rows = list(enumerate(texts))
    assert len({r.fp for r in simhash_gray.fingerprints(frame(rows), 5).collect()}) == 1
    assert components(similar.similar_documents(frame(rows))) == Counter([(0, 0), (1, 1), (2, 1)])


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def passages(rng, n, alphabet):
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(20, 90))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(30)) for _ in range(5)]
        texts.append("".join(parts))
    return [*texts, "a" * 200, "a" * 41, "ab" * 60, texts[0], texts[0], "", None, "é" * 50]


def test_repeats_equal_brute_force(frame):
    rng = random.Random(6)
    for alphabet, merge, shard in (("ab", 64, 8), ("abcdefgh é", 4096, 512), ("abc", 3, 2)):
        texts = passages(rng, 40, alphabet)
        rows = [(i % 45, t) for i, t in enumerate(texts)]
        found = bwt_dedup.remove_repeats(frame(rows), 40, 20, merge, shard)
        got = Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found.collect())
        assert got == Counter((i, *w) for (i, _), w in zip(rows, brute_repeats(texts, 40)))


def test_merged_transforms_equal_one(spark):
    rng = np.random.default_rng(7)
    rows = rng.integers(97, 100, (60, 30)).astype(np.uint8)
    rows[::7] = rows[0]
    whole = bwt_dedup.merged_repeats([bwt_dedup.transform(rows)], 12)
    parts = bwt_dedup.merged_repeats([bwt_dedup.transform(rows[a : a + 13]) for a in range(0, 60, 13)], 12)
    seen = [Counter(bytes(r[s : s + 12]) for r in rows) for s in range(19)]
    want = np.array([[seen[s][bytes(r[s : s + 12])] > 1 for r in rows] for s in range(19)])
    assert (whole == want).all() and (parts == want).all()


def test_repeats_of_odd_rows(frame, odd_rows):
    rows = bwt_dedup.remove_repeats(frame(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert all(len(r.kept) == 0 for r in rows if r.doc_id == 5)
    assert bwt_dedup.remove_repeats(frame([])).count() == 0
