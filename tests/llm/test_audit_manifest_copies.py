"""Filter audit, Merkle manifest and circulant MinHash against plain Python."""

import itertools
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from answerloom.llm import circulant, filter_audit, merkle
from answerloom.llm import texts as T
from answerloom.llm.queries import REGISTRY

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit -----------------------------------------------------------------------------------


def brute_fails(rows):
    """The failed filters of each (id, text)."""
    out = []
    for number, text in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)) + "D" * bool(set(text) & set("#$%&*|"))
        fails += "E" * (number is not None and any(i is not None and i < number and (t or "") == text for i, t in rows))
        out.append(fails)
    return out


def brute_audit(parts, fails, good, toxic):
    out, removed_by = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in set(parts):
            left = [i for i, p in enumerate(parts) if p == part]
            every = left
            for step, own in enumerate(order, start=1):
                lost = [i for i in left if own in fails[i]]
                left = [i for i in left if own not in fails[i]]
                failing = sum(own in fails[i] for i in every)
                out[part, order, step] = [len(left), len(lost), failing - len(lost), sum(fails[i] == own for i in every),
                                          sum(good[i] for i in lost), sum(toxic[i] for i in lost)]
                removed_by[part, own] += len(lost)
    return {(*k, *v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


LABELS = "doc_id long, quality int, toxic int, mask string"


def test_audit_matches_every_order_by_hand(spark, documents_of, odd_rows):
    rng = np.random.default_rng(5)
    rows = [*odd_rows, (20, "A B C #"), (21, "A B C #"), (22, "fine " * 300), (19, "A B C #"), (20, "A B C #"), (23, None)]
    for number in range(30, 60):
        words = [f"{'W' if number % 4 == 0 else 'w'}{x}" for x in rng.integers(0, 60 if number % 3 == 0 else 9000, 150 + 5 * number % 120)]
        rows.append((number, " ".join(words) + (" 5%" if number % 5 == 0 else "")))
    docs = documents_of(rows).selectExpr("* except (lang)", "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '' ELSE 'x' END AS lang")
    labels = spark.createDataFrame([(i, i % 2, i % 3 % 2, "z") for i in range(10, 45)] + [(30, 1, None, "z"), (None, 1, 1, "z")], LABELS)
    parts = ["x" if i is None or i % 3 == 2 else "" for i, _ in rows]
    good = [i is not None and (10 <= i < 45 and i % 2 == 1 or i == 30) for i, _ in rows]
    toxic = [i is not None and 10 <= i < 45 and i % 3 == 1 for i, _ in rows]
    found = filter_audit.audit(docs, labels).collect()
    assert {tuple(r) for r in found} == brute_audit(parts, brute_fails(rows), good, toxic)
    assert len(found) == 2 * 120 * 5


def test_walk_stores_the_survivors_of_every_subset():
    cells = np.random.default_rng(2).integers(0, 50, (3, 32, 3))
    states = filter_audit.walk(cells)
    for subset in range(32):
        assert (states[:, subset] == cells[:, [m for m in range(32) if not m & subset]].sum(axis=1)).all()


def test_audit_of_nothing(spark, documents_of):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(documents_of([]), labels).count() == 0
    assert filter_audit.audit(documents_of([(1, "x")]), labels).count() == 600


# --- Merkle manifest ----------------------------------------------------------------------------------


def h(text):
    return sha256(text.encode()).hexdigest()


def brute_tree(nodes):
    """Root, and for each leaf its list of (siblings, place)."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        for run in runs:
            for place, i in enumerate(run):
                for leaf in below[i]:
                    paths[leaf].append(("".join(nodes[j] for j in run if j != i), place))
        below = [[leaf for i in run for leaf in below[i]] for run in runs]
        nodes = [h("".join(nodes[i] for i in run)) for run in runs]
    return nodes[0], paths


def brute_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_manifest(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    out, subroots = [], []
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        subroots.append((own, *brute_tree([brute_leaf(r) for r in own])))
    root, tops = brute_tree([s for _, s, _ in subroots])
    for (own, subroot, paths), top in zip(subroots, tops):
        for row, path in zip(own, paths):
            lower = None if row[4] is None else re.sub("[A-Z]", lambda m: m[0].lower(), row[4])
            tampered = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 5 == 0
            now = brute_leaf((*row[:4], lower)) if tampered else brute_leaf(row)
            for siblings, place in path + top:
                now = h(siblings[: 64 * place] + now + siblings[64 * place :])
            out.append((row[0], brute_leaf(row), subroot, root, h("".join(s for s, _ in path + top)), now, now == root))
    return Counter(out)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest_rows(df):
    return [tuple(r[f] for f in FIELDS) for r in df.collect()]


@pytest.mark.parametrize("sizes", [(1,), (16,), (17, 1), (300, 5, 2, 1), (2,) * 40])
def test_manifest_matches_a_plain_tree(spark, sizes):
    rows, number = [], 0
    for which, size in enumerate(sizes):
        for _ in range(size):
            number += 7
            rows.append((number, f"s{which}", "En", number % 5, f"Text {number}"))
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    found = Counter(tuple(r) for r in merkle.verify_documents(docs, block_levels=1).collect())
    assert found == brute_manifest(rows)
    assert {f[6] for f in found} <= {True, False} and sum(f[6] for f in found) > 0


def test_manifest_of_odd_rows(documents_of, odd_rows):
    docs = documents_of(odd_rows)
    assert Counter(tuple(r) for r in merkle.verify_documents(docs).collect()) == brute_manifest(manifest_rows(docs))
    assert merkle.verify_documents(documents_of([])).count() == 0
    assert [r.verified for r in merkle.verify_documents(documents_of([(4, "lone")])).collect()] == [True]


def test_witnesses_are_kept_apart_from_the_texts(spark, small_documents):
    leaves = merkle.leaves_of(small_documents)
    manifest = merkle.build(leaves)
    found = merkle.row_witnesses(manifest, spark).collect()
    assert len(found) == small_documents.count()
    for r in found:
        path = [(s.encode(), p) for s, p in zip(r.siblings, r.places)]
        assert merkle.folded(r.leaf.encode(), path).decode() == manifest.root
    _, want = manifest.root, brute_manifest(manifest_rows(small_documents))
    assert {w[3] for w in want} == {manifest.root}


def test_an_open_tree_extends_witnesses_as_subtrees_complete():
    digests = [h(str(i)).encode() for i in range(40)]
    tree = merkle.OpenTree(2)
    for i, digest in enumerate(digests):
        tree.append(digest)
        assert [len(w) for w in tree.witnesses] == [1] * (16 * ((i + 1) // 16)) + [0] * ((i + 1) % 16)
    root, paths = brute_tree([d.decode() for d in digests])
    assert tree.finish().decode() == root
    assert [[(s.decode(), p) for s, p in w] for w in tree.witnesses] == paths


# --- circulant MinHash --------------------------------------------------------------------------------


def brute_copies(rows):
    def shingles(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} if words else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    name = {r: min([i for i in m if i is not None], default=None) for r, m in members.items()}
    return Counter((rows[i][0], len(sets[i]), name[find(i)], rows[i][0] == name[find(i)]) for i in range(len(rows)))


def edited(rng, count, words, edits):
    base = [f"w{x}" for x in rng.integers(0, 10_000, words)]
    for number in range(count):
        new = list(base)
        for at in rng.integers(0, words, number % edits):
            new[at] = f"e{rng.integers(0, 10_000)}"
        yield " ".join(new)


def test_copies_match_brute_force(documents_of, odd_rows):
    rng = np.random.default_rng(6)
    rows = [*odd_rows, (70, "one two three"), (71, "One TWO three"), (72, "one two"), (-5, "one two three")]
    for group in range(4):
        rows += [(1000 * (group + 1) + i, t) for i, t in enumerate(edited(rng, 25, 120, 12))]
    assert Counter(tuple(r) for r in circulant.near_copies(documents_of(rows)).collect()) == brute_copies(rows)


def test_large_buckets_give_the_same(documents_of, monkeypatch):
    monkeypatch.setattr(circulant, "SMALL", 3)
    rows = list(enumerate(edited(np.random.default_rng(7), 60, 150, 9)))
    assert Counter(tuple(r) for r in circulant.near_copies(documents_of(rows)).collect()) == brute_copies(rows)
    assert circulant.near_copies(documents_of([])).count() == 0


@pytest.mark.parametrize("size", [20, 400, 20_000])
def test_coordinates_agree_as_often_as_the_sets_do(size):
    rng = np.random.default_rng(size)
    agree = []
    for _ in range(30 if size < 1000 else 6):
        shingles = T.mix(rng.integers(0, 2**63, size + size // 4, dtype=np.uint64))
        a, b = shingles[: size + size // 8], shingles[size // 8 :]  # similarity of 0.8
        agree.append((circulant.signature(a, 120) == circulant.signature(b, 120)).mean())
    assert abs(np.mean(agree) - 0.8) < 0.05


def test_bands_find_pairs_at_the_threshold():
    bands, rows = circulant.plan_bands(0.8, 0.9999, 128)
    rng, found = np.random.default_rng(9), 0
    for trial in range(300):
        size = int(rng.integers(1, 60)) * 8
        shingles = T.mix(rng.integers(0, 2**63, size * 5 // 4, dtype=np.uint64))
        a, b = (circulant.band_hashes(circulant.signature(s, bands * rows), bands) for s in (shingles[: size * 9 // 8], shingles[size // 8 :]))
        found += bool((a == b).any())
    assert found >= 299


def test_one_shingle_gives_a_window_of_the_second_permutation():
    moved, windows = circulant.permutations(120)
    shingle = np.array([0xABCDEF0123456789], np.uint64)
    place = moved[int(shingle[0] >> np.uint64(42))]
    assert (circulant.signature(shingle, 120) == windows[place]).all()
    assert (windows[5][1:] == windows[6][:-1]).all() and len(np.unique(moved)) == circulant.CIRCLE


def test_new_queries_are_registered():
    assert {"op11_filter_audit", "op12_merkle_manifest", "op13_circulant_minhash"} <= set(REGISTRY)
