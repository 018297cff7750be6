"""Operators over whole tables: toxicity, similarity join, LM scoring, decontamination; pipeline and registration."""

import itertools
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
import corpus_pipeline
from answerloom.llm import decontaminate, jaccard, mixing_lm, toxicity
from answerloom.llm.queries import REGISTRY
from answerloom.llm.texts import pieces

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(text or "")
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    links = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2)
             if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    members, count = defaultdict(list), Counter(itertools.chain(*links))
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    name = {r: min([i for i in m if i is not None], default=None) for r, m in members.items()}
    return Counter((rows[i][0], name[find(i)], count[i]) for i in range(len(rows)))


# --- similarity join ---------------------------------------------------------------------------


def test_bands_reach_their_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.9), (0.9, 0.99)):
        bands, rows = jaccard.plan_bands(threshold, recall, 128)
        assert bands * rows <= 128 and 1 - (1 - threshold**rows) ** bands >= recall
    with pytest.raises(ValueError):
        jaccard.plan_bands(0.1, 0.9999, 4)


def test_join_matches_brute_force_with_edits_of_all_sizes(documents_of, odd_rows):
    rng = np.random.default_rng(3)
    base = [[f"w{x}" for x in rng.integers(0, 10_000, 200)] for _ in range(3)]
    rows, number = list(odd_rows), 1000
    for words in base:  # a hot group: distances to its leader from none to beyond the threshold
        for edits in (0, 0, 1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 6, 8):
            new = list(words)
            for at in rng.integers(0, len(new), edits):
                new[at] = f"e{rng.integers(0, 10_000)}"
            rows.append((number, " ".join(new)))
            number += 1
    assert Counter(tuple(r) for r in jaccard.join_documents(documents_of(rows)).collect()) == brute_classes(rows)
    kept = jaccard.keep_one(documents_of(rows))
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    wordless = sum(1 for _, t in rows if not WORD.search(t or ""))
    classes = len({c for _, c, _ in brute_classes([r for r in rows if WORD.search(r[1] or "")])})
    assert kept.count() == wordless + classes


def test_large_buckets_in_blocks_give_the_same(documents_of, monkeypatch):
    rng = np.random.default_rng(4)
    words, rows = [f"w{x}" for x in rng.integers(0, 10_000, 150)], []
    for number in range(40):
        new = list(words)
        for at in rng.integers(0, len(new), number % 5):
            new[at] = f"e{rng.integers(0, 10_000)}"
        rows.append((number, " ".join(new)))
    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    assert Counter(tuple(r) for r in jaccard.join_documents(documents_of(rows)).collect()) == brute_classes(rows)


def test_join_of_no_rows(documents_of):
    assert jaccard.join_documents(documents_of([])).count() == 0 and jaccard.keep_one(documents_of([])).count() == 0


def test_components_follow_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)]
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


# --- decontamination ---------------------------------------------------------------------------


def brute_tiles(doc, item, least):
    least = max(1, min(least, len(item)))
    doc_marked, item_marked, total = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (0, 0, 0)
        for d, p in itertools.product(range(len(doc)), range(len(item))):
            k = 0
            while d + k < len(doc) and p + k < len(item) and doc[d + k] == item[p + k] and not doc_marked[d + k] and not item_marked[p + k]:
                k += 1
            best = max(best, (k, -d, -p))
        if best[0] < least:
            return total
        for k in range(best[0]):
            doc_marked[k - best[1]] = item_marked[k - best[2]] = True
        total += best[0]


def test_tiles_match_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        doc, item = (rng.integers(0, 4, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C1) for n in (50, rng.integers(1, 25)))
        assert sum(t[0] for t in decontaminate.tile(doc, item)) == brute_tiles(doc.tolist(), item.tolist(), 4)


def test_reordered_and_short_passages_are_found(spark, documents_of, odd_rows):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    words = item.split()
    turned = " ".join([*words[8:], "and then", *words[:8]])
    rows = odd_rows + [(30, f"some words {item.upper()}! and more"), (31, turned), (32, " ".join(words[::-1])),
                       (33, " ".join(words[:6])), (34, "yes it is"), (None, item)]
    bench = spark.createDataFrame([(1, item, "x"), (1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "it is", "x")],
                                  "item_id long, text string, seed string")
    found = decontaminate.contaminated(documents_of(rows), bench).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == Counter([(30, 1), (31, 1), (None, 1), (34, 4)])
    assert next(r for r in found if r.doc_id == 31).n_tiles == 2
    clean = decontaminate.decontaminate(documents_of(rows), bench)
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, t in rows) - Counter([30, 31, None, 34])
    assert decontaminate.contaminated(documents_of(rows), bench.limit(0)).count() == 0
    assert decontaminate.contaminated(documents_of([]), bench).count() == 0


def test_pairs_are_those_of_tiling_every_document_with_every_item(spark, documents_of):
    """A lead-in that all share makes no pairs; coverage and long runs decide as if each pair were tiled."""
    rng = np.random.default_rng(21)

    def some(count):
        return [f"w{x}" for x in rng.integers(0, 5000, count)]

    lead = "once upon a time there".split()
    items = [(i, lead + some(40)) for i in range(12)]
    rows = [(i, lead + some(30)) for i in range(12)]
    for i, words in items:
        rows.append((100 + i, some(10) + words[6 : 6 + 9 + i % 6] + some(10)))  # 9 to 14 words in a row
        rows.append((200 + i, words[25:38] + some(3) + words[5:20] + some(3) if i % 2 else words[30:42] + some(2) + words[8:17]))
        rows.append((300 + i, [w for j in range(0, 40, 5) for w in [*words[j : j + 3], "x"]]))  # runs below a seed
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    found = decontaminate.contaminated(documents_of([(i, " ".join(w)) for i, w in rows]), bench).collect()
    want = {}
    for i, item in items:
        tokens = decontaminate.tokens_of(" ".join(item))
        for d, doc in rows:
            lengths = [t[0] for t in decontaminate.tile(decontaminate.tokens_of(" ".join(doc)), tokens)]
            if sum(lengths) >= 0.5 * len(tokens) or max(lengths, default=0) >= 13:
                want[d, i] = (len(tokens), sum(lengths), max(lengths))
    assert {(r.doc_id, r.item_id): (r.item_words, r.tiled_words, r.longest_tile) for r in found} == want
    assert {d for d, _ in want} >= {104, 105} and 103 not in {d for d, _ in want} and any(200 <= d < 300 for d, _ in want)


def test_seeds_in_several_blocks_give_the_same(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    once = sorted(tuple(r) for r in decontaminate.contaminated(docs, bench).drop("mark").collect())
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 1500)
    assert once and sorted(tuple(r) for r in decontaminate.contaminated(docs, bench).drop("mark").collect()) == once


# --- toxicity ----------------------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = REGISTRY["op1_toxicity"](spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic, other = ([r.predicted for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean(toxic) > 0.85 and np.mean(other) < 0.02


def test_toxicity_cases(spark, documents_of, odd_rows):
    docs = documents_of(odd_rows)
    none = spark.createDataFrame([], "doc_id long, toxic int, score int")
    scored = toxicity.score_documents(docs, none).collect()
    assert len(scored) == len(odd_rows) and {r.score for r in scored} == {0.0}
    rows = [(100 + i, ("vile slur words " if i % 2 else "kind words only ") * 5 + str(i)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, None) for i, _ in rows] + [(None, 1, None), (101, None, None), (101, 0, None)],
                                   "doc_id long, toxic int, score int")
    scored = {r.doc_id: r for r in toxicity.score_documents(documents_of(rows + odd_rows[2:5]), labels).collect()}
    assert all(scored[i].predicted == i % 2 for i, _ in rows) and scored[2].score == scored[3].score
    assert all(scored[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)


# --- LM scoring --------------------------------------------------------------------------------


def test_lm_base_score_matches_brute_force(documents_of, odd_rows, small_documents):
    rows = odd_rows + [(10_000 + r.doc_id, r.text) for r in small_documents.limit(60).collect()]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, distinct = sum(count.values()), len(count)
    got = sorted(mixing_lm.score_documents(documents_of(rows)).collect(), key=lambda r: (r.doc_id or -1, r.n_tokens, r.base_score))
    want = sorted(((i, held(i), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)),
                    sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in tokens(t))) for i, t in rows),
                  key=lambda r: (r[0] or -1, r[2], r[4]))
    for r, w in zip(got, want, strict=True):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (*w[:4], total)
        assert r.base_score == pytest.approx(w[4], rel=1e-9) and r.score < 0


def test_lm_is_a_probability_and_learns(spark):
    """Over all one-byte continuations of a text the probabilities sum to at most one."""
    counts = np.bincount(np.frombuffer(b"the cat and the dog and the hen" * 50, np.uint8), minlength=256)
    code = mixing_lm.Code.of(counts)
    assert sum(0.5 ** code.length.astype(float)) == pytest.approx(1)
    table = np.zeros(-(-mixing_lm.SLOTS // mixing_lm.BLOCK_SLOTS) * mixing_lm.BLOCK_SLOTS << 8, np.int8)
    model = mixing_lm.MixModel(code, table, *mixing_lm.start_state())
    import pyarrow as pa
    from answerloom.llm.texts import pieces

    def score(rows):
        return np.concatenate([mixing_lm.mix(p, model)[0] for p in pieces(pa.array(rows))])

    ascii_rows = [chr(i) for i in range(128)]
    assert 0 < (10 ** score(["", *ascii_rows])).sum() < 1
    both, alone = score(["abc", "the cat " * 900]), score(["the cat " * 900])
    assert both[1] == pytest.approx(alone[0], rel=1e-6)
    assert mixing_lm.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_lm_counts_are_held_in_one_table():
    """What a counting task takes follows its limit closely, and no count is lost when keys leave it."""
    def counted(limit, parts):
        held, out = mixing_lm._Held(mixing_lm.CONTEXTS, limit), Counter()
        for batch in itertools.chain(*(held.add(*np.unique(x, return_counts=True)) for x in parts), held.rest()):
            for key, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out[key] += n
        return out

    rnd = np.random.default_rng(5)
    parts = [rnd.integers(0, 900, 200, np.uint64) for _ in range(50)]
    for limit in (1, 100, 800, 5000):
        assert counted(limit, parts) == Counter(np.concatenate(parts).tolist())
    held = mixing_lm._Held(mixing_lm.CONTEXTS, limit := 1 << 16)
    tracemalloc.start()
    for _ in range(60):
        for _ in held.add(*np.unique(rnd.integers(0, 1 << 40, 4000, np.uint64), return_counts=True)):
            pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * 16 * limit


def test_lm_mixes_a_piece_in_parts(monkeypatch):
    """Each part of a piece gives the same numbers as the whole piece at once, and takes less memory."""
    rnd = np.random.default_rng(3)
    rows = ["".join(map(chr, rnd.integers(97, 117, size))) for size in rnd.integers(0, 4000, 200)] + ["", "x" * 20_000, ""]
    (piece,) = pieces(pa.array(rows), mixing_lm.PIECE)
    model = mixing_lm.MixModel(mixing_lm.Code.of(np.bincount(piece.data, minlength=256)), np.zeros(0, np.int8),
                               *mixing_lm.start_state())
    got, peaks = [], []
    for part in (mixing_lm.PIECE, 10_000):
        monkeypatch.setattr(mixing_lm, "PART", part)
        tracemalloc.start()
        got.append(mixing_lm.mix(piece, model, usage=True))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(*got, strict=True))
    assert len(got[0][0]) == len(rows) and peaks[1] < peaks[0] / 3


def test_lm_finds_the_odds_of_every_node_without_shuffling_texts(spark, small_documents, tmp_path, monkeypatch):
    """The log-odds along each path are those of brute force over the counts, also for bytes not seen in
    their context; batches of files hold whole contexts; what is written is keys and counts, never texts."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing_lm, "BATCH_PAIRS", 500)
    rows = small_documents.limit(20).select(
        F.lit(False).alias("held_out"), F.lit(0).alias("rest"), F.coalesce("text", F.lit("")).alias("text"))
    partial = mixing_lm.count_corpus(rows, needs=False)
    assert partial.columns == ["kind", "key", "n"]
    counts = partial.groupBy("kind", "key").agg(F.sum("n").alias("n")).localCheckpoint()
    count = {r.key: r.n for r in counts.where(F.col("kind") == mixing_lm.CONTEXTS).collect()}
    code = mixing_lm.Code.of(np.bincount([k & 255 for k in count], list(count.values()), 256))
    files = tuple(mixing_lm.write_paths(counts.where(F.col("kind") == mixing_lm.CONTEXTS), code, f"{tmp_path}/paths"))
    assert sum(len(keys) for keys, *_ in mixing_lm.mapped(files)) == len(count)
    model = mixing_lm.MixModel(code, np.zeros(0, np.int8), *mixing_lm.start_state(), files)
    ends = defaultdict(Counter)
    for key, n in count.items():
        for node, bit in zip(*code.paths(np.array([key & 255]))[1:], strict=True):
            ends[key >> 8, int(node)][int(bit)] += n
    asked = sorted({key & ~255 | byte for key in list(count)[::37] for byte in (key & 255, 101, 255, 0)} | {1 << 61, 5})
    odds, starts = model.odds(np.array(asked, np.uint64))
    for key, start in zip(asked, starts, strict=True):
        path = code.paths(np.array([key & 255]))[1].tolist()
        want = [round(16 * math.log((ends[key >> 8, v][1] + 0.4) / (ends[key >> 8, v][0] + 0.4))) if (key >> 8, v) in ends
                else 0 for v in path]
        assert odds[start : start + len(path)].tolist() == [max(-127, min(127, x)) for x in want]


# --- pipeline and registration -----------------------------------------------------------------


def test_every_operator_is_registered_once():
    names = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


def test_pipeline_decisions_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names, before = docs.columns, None
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, folder)
        rows = after.collect()
        ids = [r.doc_id for r in rows]
        assert len(set(ids)) == len(ids)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == names
            assert before is None or set(ids) <= before
            docs = spark.createDataFrame(rows, docs.schema)
        else:
            assert set(ids) == before
        before = set(ids)
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} == before
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    assert all(i == c and n == 0 for i, c, n in brute_classes(texts))


# --- mixing model ------------------------------------------------------------------------------


def test_lm_keeps_every_context_of_the_corpus(spark, small_documents):
    """The counts are those of brute force, whatever the number of contexts, and each part gets all that it needs."""
    from pyspark.sql import functions as F

    docs = small_documents.select(
        F.col("doc_id").alias("key"), (F.col("doc_id") % 5 == 0).alias("held_out"),
        (F.col("doc_id") % 7).cast("int").alias("rest"), F.coalesce("text", F.lit("")).alias("text"))
    partial = mixing_lm.count_corpus(docs).localCheckpoint()
    got = {r.context: {x & 255: x >> 8 for x in r.nexts} for r in mixing_lm.context_counts(partial).collect()}
    want, needs = defaultdict(Counter), set()
    for r in docs.collect():
        data = bytes(6) + r.text.encode() + b"\xff"
        for k, order in enumerate(mixing_lm.ORDERS):
            for i in range(6, len(data)):
                context = k << 48 | int.from_bytes(data[i - order : i], "big")
                needs.add(context)
                if not r.held_out and r.rest != mixing_lm.MIX_FOLD:
                    want[context][data[i]] += 1
    assert got == want and len(want) > (1 << 14) + 3 * (1 << 15)
    assert {r.key for r in partial.where(F.col("kind") == mixing_lm.NEEDS).collect()} == needs
