"""Operators on single texts: quality rules, token files, BPE, edit counts, WARC, license scan; all SQL checks."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from answerloom.llm.oracles import ORACLES
from answerloom.llm.queries import REGISTRY
from check_oracles import compare, connect
from answerloom.llm import bpe, edit_counts, license_scan, quality, shared_files, texts, token_files, warc

BYTE_BPE, WORD_BPE = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = ["a", "b c", " ", "  ", "\n", " \n ", "it's", "'s ", "é", "12", "!?", " x", "\xa0", "\t ", "<|endoftext|>",
         "\x1c", "\x85 ", "Σ", "ΑΣ ", "漢字", "x " * 70]


def mixed_texts(count, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(count)]


def library(path):
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, name).startswith("ok")


# --- helpers -----------------------------------------------------------------------------------


def test_words_lines_and_hashes_do_not_depend_on_the_batch():
    rows = ["", "a b", None, "a b\n", "\n\na b", "x"]
    column = pa.array(rows)
    for limit in (1, 5, 1 << 18):
        found = []
        for piece in texts.pieces(column, limit):
            starts, ends, first = piece.words()
            hashes = texts.span_hash(piece.prefix(), starts, ends)
            found += [hashes[first[i] : first[i + 1]].tolist() for i in range(piece.rows)]
        assert [len(x) for x in found] == [0, 2, 0, 2, 2, 1]
        assert found[1] == found[3] == found[4]
    (piece,) = texts.pieces(column)
    begin, end, row = piece.lines()
    assert [piece.data[a:b].tobytes().decode() for a, b in zip(begin, end)] == ["", "a b", "", "a b", "", "", "", "a b", "x"]
    assert row.tolist() == [0, 1, 2, 3, 3, 4, 4, 4, 5]


# --- quality -----------------------------------------------------------------------------------


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, covered, seen, again = Counter(grams), set(), set(), 0
    for i, gram in enumerate(grams):
        if count[gram] > 1:
            covered |= set(range(i, i + 5))
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def test_quality_figures_match_brute_force(documents_of, odd_rows):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(mixed_texts(60, 1))] + [(99, "x y z " * 5), (98, "a\n\na\na")]
    got = quality.judge_documents(documents_of(rows)).collect()
    want = Counter((i, *brute_base(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)


def test_phrases_count_between_word_boundaries_and_by_their_share(documents_of):
    clean = [
        "The catalog in the library lists every single book that the town has ever owned and lent.",
        "Her blog in the paper tells how people spread more kindness when they design up to date gardens.",
        "You can read more about the long history of the bridge in the second chapter of this book.",
        "Öread more über, and naïve_log in_words or 7sign up8 are all no phrases of their own at all here.",
    ]
    bad = ["Read more about it. Share this! Sign up, log in, or go back to top of it all now.", "Copyright 2019 by Ann Lee & Sons. All Rights Reserved."]
    judged = {r.doc_id: r for r in quality.judge_documents(documents_of(list(enumerate(clean + bad)))).collect()}
    assert [judged[i].n_failed_lines for i in range(6)] == [0, 0, 0, 0, 1, 1]
    assert all(judged[i].kept for i in range(4))


def test_lines_that_fail_go_and_documents_that_lose_too_much_go(documents_of):
    good = "This is a sentence of quite some words that nobody would object to, is it not so."
    more = "A second paragraph follows here with other words, so nothing repeats in it at all."
    rows = [(1, f"{good}\nHome | News | About | Contact | Login\n{more}"), (2, "Home | News | About | More | A | B"),
            (3, f"{good}\nAll Rights Reserved by us and everyone else here.\n\n{more}"), (4, good), (5, None),
            (6, "### $$$ %%% &&& *** ||| <<< >>> ### $$$ ***")]
    kept = {r.doc_id: r for r in quality.clean_documents(documents_of(rows)).collect()}
    assert sorted(kept) == [1, 3, 4]
    assert kept[1].text == f"{good}\n{more}" and kept[1].n_chars == len(kept[1].text)
    assert kept[3].text == f"{good}\n\n{more}" and kept[4].text == good and kept[4].key == "x"


# --- token files -------------------------------------------------------------------------------


def test_token_files_hold_the_library_ids_in_key_order(spark, documents_of, odd_rows):
    rows = [r for r in odd_rows if r[0] is not None] + [(100 + i, t) for i, t in enumerate(mixed_texts(80, 2))]
    rows = list({i: (i, t) for i, t in rows}.values())
    got = {r.doc_id: r for r in token_files.write_and_read(documents_of(rows), BYTE_BPE, 2).collect()}
    tokenizer, at = library(BYTE_BPE), 0
    for i, text in sorted(rows):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4")))
        at += len(ids)


def test_sequences_are_reached_at_random_and_masked(tmp_path):
    path, ids = str(tmp_path / "x.arrow"), np.arange(10_000, dtype="<u2")
    with shared_files.created(path) as out:
        writer = token_files.SequenceWriter(out, np.dtype("<u2"), 16)
        for part in np.split(ids, [3, 3, 5_000]):
            writer.add(part)
        writer.close()
    file = token_files.SequenceFile(path)
    assert len(file) == 625 and (file.sequence(624) == ids[-16:]).all() and file.mask(624).all()
    assert (file.span(1_000, 3_000) == ids[1_000:4_000]).all() and len(file.span(7, 0)) == 0
    assert file.sequence(100).base is not None  # a view of the mapped file


class _Listening:
    """A library that counts the characters it is given."""

    def __init__(self, library):
        self.library, self.characters = library, 0

    def __getattr__(self, name):
        if not name.startswith("encode"):
            return getattr(self.library, name)

        def call(texts, **options):
            self.characters += sum(map(len, texts))
            return getattr(self.library, name)(texts, **options)

        return call


PARTED_TEXTS = [
    "start " + " ".join(f"thewordish{end}" for end in (*".,;:!?%&", "...", "!!", "\nthewordish,", ".\nthewordish")) + " end",
    "", " ", "one", "  a", "a  b c", "a \n b", "x <|endoftext|> y, z", "word's, isn't o'k 12a, a1", "été, œuvre. ı 'll",
    "a\x1cb c\x85 d", "ab,\ncd; ef.\n\ngh", "a b\n c", "x a\n1b c", "z lm\n,o p", "q a,\nb\nc! d"]


def test_pieces_are_encoded_once_for_all_punctuation_behind_them():
    import pyarrow as pa

    work = token_files.SplitEncoder(BYTE_BPE)
    work.library = _Listening(work.library)
    work.encode(pa.array(PARTED_TEXTS[:1]))
    assert work.library.characters < 0.5 * len(PARTED_TEXTS[0])
    ids, counts = work.encode(pa.array(PARTED_TEXTS))
    want = [x.ids for x in work.library.encode_batch_fast(PARTED_TEXTS, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
    assert [len(x) for x in work.encode(pa.array([], pa.string()))] == [0, 0]


def test_pretokens_are_encoded_once_for_all_punctuation_behind_them():
    counter = edit_counts.PretokenCounter(BYTE_BPE)
    counter.library = _Listening(counter.library)
    counter.leaves_of(PARTED_TEXTS[:1])
    assert counter.library.characters < 0.5 * len(PARTED_TEXTS[0])
    for text, leaves in zip(PARTED_TEXTS, counter.leaves_of(PARTED_TEXTS), strict=True):
        spelled = edit_counts.PRETOKEN.findall(text)
        want = [len(x.ids) for x in counter.library.encode_batch_fast(spelled, add_special_tokens=False)]
        assert leaves.tolist() == [[len(t), n] for t, n in zip(spelled, want, strict=True)]


def test_token_files_of_no_rows(documents_of):
    assert token_files.write_and_read(documents_of([]), BYTE_BPE, 2).count() == 0


# --- byte-pair encoding ------------------------------------------------------------------------


def test_forced_boundaries_give_the_library_ids_and_decoding():
    work, tokenizer = bpe.ForcedBoundaryEncoder(WORD_BPE), library(WORD_BPE)
    cases = mixed_texts(300, 3) + ["ΟΔΟΣ Σ", "İstanbul ﬁn Å", "a<|endoftext|>B <|startoftext|>", "''' 's's''s", "\x1ca\x1db \x00"]
    for text in cases:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        ids = work.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert work.decode(ids) == tokenizer.decode(want, skip_special_tokens=False)


def test_cuts_are_forced():
    work = bpe.ForcedBoundaryEncoder(WORD_BPE)
    cut = next((a, b) for a in "qxzj" for b in "qxzj" if (a, b) not in work.inside)
    assert not any("".join(cut) in t.removesuffix("</w>") for t in work.ids)
    assert work.encode_word("ab" + "".join(cut) + "cd") == work.merge("ab" + cut[0], False) + work.merge(cut[1] + "cd", True)


def test_bpe_query_digests_and_round_trip(documents_of, odd_rows):
    docs, tokenizer = documents_of(odd_rows), library(WORD_BPE)
    got = Counter(tuple(r) for r in bpe.digest_documents(docs, WORD_BPE).collect())
    want = Counter()
    for i, text in odd_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want
    back = bpe.decode_documents(bpe.encode_documents(docs, WORD_BPE), WORD_BPE).collect()
    assert Counter(hashlib.sha256(r.text.encode()).hexdigest() for r in back) == Counter(k[3] for k in want.elements())


# --- edit counts -------------------------------------------------------------------------------


def test_counts_after_edits_equal_a_full_recount():
    counter, rnd = edit_counts.PretokenCounter(BYTE_BPE), random.Random(7)
    full = lambda t: len(counter.library.encode(t, add_special_tokens=False).ids)
    for text in mixed_texts(150, 4) + ["plain words here " * 400]:
        tree = edit_counts.PretokenTree(counter.leaves(text))
        assert tree.tokens == full(text)
        for _ in range(3):
            points = sorted(rnd.randint(0, len(text)) for _ in range(2 * rnd.randint(1, 4)))
            edits = [(a, b, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 3)))) for a, b in zip(points[::2], points[1::2])]
            want = text
            for a, b, new in reversed(edits):
                want = want[:a] + new + want[b:]
            tree = edit_counts.PretokenTree.unpacked(*tree.packed())
            text, _ = edit_counts.edited(text, edits, tree, counter)
            assert text == want and tree.tokens == full(text) and tree.chars == len(text)


def test_an_edit_in_a_long_text_encodes_little_again():
    counter, text = edit_counts.PretokenCounter(BYTE_BPE), "some plain words stand here " * 2000
    tree = edit_counts.PretokenTree(counter.leaves(text))
    assert edit_counts.edited(text, [(30_000, 30_003, "XY")], tree, counter)[1] < 60


def test_edits_out_of_order_are_an_error():
    counter = edit_counts.PretokenCounter(BYTE_BPE)
    with pytest.raises(ValueError):
        edit_counts.edited("abc def", [(4, 5, ""), (2, 3, "")], edit_counts.PretokenTree(counter.leaves("abc def")), counter)


def test_edit_query_matches_recount(documents_of, odd_rows):
    docs = documents_of(odd_rows + [(50, "same\nother 123456\nsame\nsame")])
    trees = edit_counts.build_trees(edit_counts.masking_edits(docs), BYTE_BPE, ("doc_id", "text", "edits"))
    counter = edit_counts.counter(BYTE_BPE)
    count = lambda t: len(counter.library.encode(t, add_special_tokens=False).ids)
    rows = edit_counts.apply_edits(trees, BYTE_BPE).collect()
    assert len(rows) == len(odd_rows) + 1
    for r in rows:
        assert r.n_tokens_after == count(r.text)
        assert edit_counts.PretokenTree.unpacked(r.leaves, r.blocks, r.sums).tokens == r.n_tokens_after
    changed = next(r for r in rows if r.doc_id == 50)
    assert changed.text.endswith("same\nother <number>") and changed.n_edits == 4


def test_edit_query_is_one_python_step(spark, documents_of, odd_rows, tmp_path):
    """Each further step would be a further process beside every core, with a vocabulary and a memory of its own."""
    docs = documents_of(odd_rows + [(50, "same\nother 123456\nsame\nsame")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = REGISTRY["op6_edit_counts"](spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    trees = edit_counts.build_trees(edit_counts.masking_edits(docs), BYTE_BPE, ("doc_id", "text", "edits"))
    want = edit_counts.apply_edits(trees, BYTE_BPE, keep_trees=False).drop("text")
    assert got.schema == want.schema
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


# --- archives ----------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_archives_round_trip_with_revisits(spark):
    big, other = "<p>é</p>" * 40, "y" * 100
    rows = [(5, "http://a/5", big), (3, "http://a/3\r\nX: y", big), (9, None, big), (4, "u", "small"), (8, "u", "small"),
            (1, "u", None), (2, "u", ""), (7, "u", other), (7, "u", other), (None, "u", other), (10, "u", "z" * 99), (11, "u", "z" * 99)]
    got = Counter(tuple(r) for r in warc.archive_pages(pages(spark, rows)).collect())
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        first = {big: 3, other: 7}.get(html)
        want[page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if first not in (None, page) else "response",
             first if first != page else None] += 1
    assert got == want
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_normaliser_makes_one_member_a_record(tmp_path):
    records = [warc.record(i, "u", b"\r\n\r\n" * i + b"x", "00", None) for i in range(50)]
    whole = str(tmp_path / "whole.warc.gz")
    stream = zlib.compressobj(6, zlib.DEFLATED, warc.ONE_MEMBER)
    with open(whole, "wb") as out:
        out.write(stream.compress(b"".join(records)) + stream.flush())
    assert warc.normalise_file(whole, str(tmp_path / "new.warc.gz")) == 50
    index = pa.ipc.open_file(str(tmp_path / "new.warc.gz.index")).read_all().to_pylist()
    with shared_files.opened(str(tmp_path / "new.warc.gz")) as file:
        assert [warc.read_record(file, r["offset"], r["length"]) for r in index] == records
    for chunk in (1, 7, 1 << 20):
        assert list(warc.inflated_records(pa.OSFile(whole), chunk)) == records
    with open(whole, "rb") as file:
        cut = file.read()[:-40]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.inflated_records(pa.BufferReader(cut)))


# --- licenses ----------------------------------------------------------------------------------


def test_licenses_by_phrase_and_by_template(documents_of, odd_rows):
    mit = license_scan.TEMPLATES["mit"]
    edited = mit.replace("free of charge", "wholly free of any charge")
    rows = odd_rows + [(20, "x " * 50 + "MIT License, apache LICENSE and the mit-license"), (21, f"intro words here {mit} more"),
                       (22, f"a b {edited} c d"), (23, "permission is hereby granted to no one at all"), (24, "general public\nlicense")]
    got = license_scan.scan(documents_of(rows)).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got}
    assert (found[20].n_base, found[20].first_word, found[20].last_word, found[20].base_labels) == (3, 50, 56, "apache,mit")
    assert found[21].labels == "mit" and found[21].base_labels == "" and found[21].score == 1.0
    assert found[22].labels == "mit" and 0.6 <= found[22].score < 1.0
    assert found[23].labels == "" and found[23].score == 0.0 and found[24].base_labels == "gpl"
    assert (found[2].n_words, found[2].n_base, found[2].first_word) == (0, 0, None)
    assert "Python" not in license_scan.scan(documents_of(rows))._jdf.queryExecution().executedPlan().toString()


def test_shared_words_of_licenses_give_no_label(documents_of):
    """Lead-ins, names with a word put in, and short templates in part."""
    other = [
        "Released under the BSD License", "The film was released under the title Dawn", "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Mozilla Public License, Version 2.0", "This work is licensed under a proprietary licence",
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of the Font Software"]
    whole = sorted(license_scan.TEMPLATES.items())
    rows = [(i, t) for i, t in enumerate(other)] + [(100 + i, f"Some words. {t} and more") for i, (_, t) in enumerate(whole)]
    found = {r.doc_id: r for r in license_scan.scan(documents_of(rows)).collect()}
    assert all((found[i].labels, found[i].score) == (found[i].base_labels, 0.0) for i in range(len(other)))
    assert found[4].labels == "" and found[5].labels == "gpl"  # the base phrase of three words stands in it
    for i, (name, _) in enumerate(whole):
        assert name.split("-")[0] in found[100 + i].labels.split(",") and found[100 + i].score == 1.0
