"""Each operator against brute force on awkward rows, on no rows, and with clashing columns."""

import zlib

import brute
import numpy as np
import pytest
from texts import SCHEMA, WORDS, awkward, frame, prose

from tidemark.llm import bpe
from tidemark.llm.bucket_refinement import remove_repeats
from tidemark.llm.compact_windows import repeated_passages
from tidemark.llm.components import components
from tidemark.llm.divergence import judge
from tidemark.llm.language_id import fit_language_model, identify
from tidemark.llm.license_scan import TEMPLATES, scan_licenses
from tidemark.llm.minmax_dedup import near_components, one_per_component
from tidemark.llm.mixing import mix_sources, mixed
from tidemark.llm.positional_index import (
    benchmark_windows,
    clean_documents,
    decontaminate,
    find_windows,
    positional_index,
)
from tidemark.llm.separator_scan import count_tokens, write_token_files
from tidemark.llm.token_records import frame as framed
from tidemark.llm.token_records import read_digests, read_ids, unframe, write_records

BENCH = [(1, prose(2, 70)), (2, "One."), (3, None), (None, prose(5, 10)), (4, " -- "), (1, prose(2, 70)), (5, prose(99, 30))]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def texts(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="module", params=[False, True], ids=["plain", "clash"])
def docs(spark, request):
    return frame(spark, clash=request.param)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string")


# near duplicates


def test_near_components(docs):
    got = rows_of(near_components(docs), "doc_id", "n_shingles", "component_id")
    assert got == brute.near(texts(awkward()))


def test_near_components_of_nothing(nothing):
    assert near_components(nothing).count() == 0
    assert one_per_component(nothing).columns == nothing.columns


def test_a_large_family_on_both_sides_of_the_threshold(spark):
    import random

    r = random.Random(5)
    base = prose(8, 100).split()
    rows = []
    for i in range(150):
        words = list(base)
        for at in r.sample(range(100), r.randrange(1, 12)):
            words[at] = f"edit{r.randrange(10_000)}"
        rows.append((i, " ".join(["shared", "first", "line", "of", "many"] * (i % 2) + words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(near_components(df), "doc_id", "n_shingles", "component_id") == brute.near(rows)


def test_one_per_component(docs):
    kept = one_per_component(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in brute.near(texts(awkward())) if i is not None and i == c}
    ids = [r.doc_id for r in kept.filter("doc_id IS NOT NULL").select("doc_id").collect()]
    assert set(ids) == want and len(ids) == len(want)
    assert kept.filter("doc_id IS NULL").count() == 2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 120)] + [(7, 7), (130, 131), (131, 130)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 120)}, 130: 130, 131: 130}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# repeated bytes


def test_remove_repeats(docs):
    got = rows_of(remove_repeats(docs, with_texts=False), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.removed_bytes(texts(awkward()))


def test_remove_repeats_at_edges(spark):
    text = prose(20, 400)
    rows = [(1, text), (2, text[:200]), (3, text[100:299]), (4, "x" + text[300:500] + "y"), (5, text[500:700] + text[600:800]),
            (6, "q" * 199), (7, "r" * 200), (8, "ab" * 150), (9, text[900:1099] + "z")]
    rows += [(20 + i, prose(50 + i, 20) + text[1200 + i : 1450 - i] + prose(80 + i, 20)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = remove_repeats(df)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.removed_bytes(rows)
    by_id = dict(rows)
    for r in got.collect():
        left, at = b"", 0
        for s in r.spans:
            left, at = left + by_id[r.doc_id].encode()[at : s.start], s.end
        assert bytes(r.kept) == left + by_id[r.doc_id].encode()[at:]


def test_long_text_in_segments(spark, monkeypatch):
    from tidemark.llm import text as pieces

    monkeypatch.setattr(pieces, "PIECE", 1 << 12)
    long = prose(31, 9000)
    rows = [(1, long), (2, long[20_000:20_450]), (3, prose(32, 300))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(remove_repeats(df, False), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.removed_bytes(rows)


def test_remove_repeats_of_nothing(nothing):
    assert remove_repeats(nothing).count() == 0


# benchmark passages


def test_decontaminate(docs, bench):
    got = rows_of(decontaminate(docs, bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contaminated(texts(awkward()), BENCH)


def test_decontaminate_without_sent_vocabulary(docs, bench, monkeypatch):
    from tidemark.llm import positional_index as module

    monkeypatch.setattr(module, "MAX_SENT_TERMS", 0)
    got = rows_of(decontaminate(docs, bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute.contaminated(texts(awkward()), BENCH)


def test_decontaminate_empty_tables(docs, nothing, bench):
    assert decontaminate(nothing, bench).count() == 0
    none = decontaminate(docs, bench.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == len(awkward())


def test_clean_documents(docs, bench):
    kept = clean_documents(docs, bench)
    assert kept.columns == docs.columns
    want = sorted((r[0] for r in brute.contaminated(texts(awkward()), BENCH) if not r[5]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x alpha beta gamma y"), (2, "alpha and beta gamma"), (3, "gamma beta alpha far")], "doc_id long, text string")
    windows = benchmark_windows(spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string"))
    index = positional_index(docs, None).filter("term IS NOT NULL")
    count = lambda slop: sorted(r.exact for r in find_windows(index, windows, slop).select("text_key", "exact").distinct().collect())
    assert count(0) == [True]
    assert count(1) == [False, True]
    assert count(4) == [False, False, True]


# token files


def encoded(rows, end, special_as_text=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.tokenizer_path())
    t.encode_special_tokens = special_as_text
    return [t.encode(x or "", add_special_tokens=False).ids + [end] for _, x in rows]


def test_token_records(docs):
    index = write_records(docs, n_files=3)
    got = rows_of(read_digests(index), "doc_id", "n_tokens", "ids_crc32")
    ids = encoded(texts(awkward()), bpe.END_ID)
    want = [(r[0], len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r, i in zip(awkward(), ids)]
    assert got == sorted(want, key=repr)
    found = [(r.doc_id, r.start, r.n_tokens) for r in index.orderBy("part", "seq").collect()]
    keys = [-1 if d is None else d for d, _, _ in found]
    assert keys == sorted(keys)
    assert [s for _, s, _ in found] == [sum(n for _, _, n in found[:i]) for i in range(len(found))]
    some = {r.doc_id: r.ids for r in read_ids(index.filter("doc_id IN (3, 12, 15)")).collect() if r.doc_id != 12}
    assert some == {r[0]: i for r, i in zip(awkward(), ids) if r[0] in (3, 15)}


def test_token_records_of_nothing(nothing):
    assert read_digests(write_records(nothing)).count() == 0


def test_damaged_records_are_noticed():
    record = framed(b"\1\2\3\4")
    assert unframe(record) == b"\1\2\3\4"
    for i in range(len(record)):
        with pytest.raises(ValueError):
            unframe(record[:i] + bytes([record[i] ^ 1]) + record[i + 1 :])


def test_encoder_equals_the_library_on_any_text():
    import random

    r = random.Random(2)
    signs = list("ab zE'sté  \x1c\x85 \n\t.,!?*)(<1２½_-​日本\U0001f600\r") + ["'ll", "<|endoftext|>", "  ", "word", "Word,"]
    made = [(None, "".join(r.choice(signs) for _ in range(r.randrange(25)))) for _ in range(4000)]
    for as_text in (False, True):
        e = bpe.BpeEncoder(bpe.tokenizer_path(), as_text)
        e.known.clear()
        got = [np.frombuffer(b, e.dtype).tolist() for b in e.encode([t for _, t in made])]
        assert got == [i[:-1] for i in encoded(made, 0, as_text)]


def test_encoder_keeps_little_of_each_word():
    import tracemalloc

    e = bpe.BpeEncoder(bpe.tokenizer_path())
    e.encode(["a"])  # makes the tables that do not grow
    tracemalloc.start()
    for i in range(0, 100_000, 10_000):
        e.encode([" ".join(f"w{chr(97 + j % 26)}{chr(97 + j // 26 % 26)}{chr(97 + j // 676 % 26)}{chr(97 + j // 17576)}" for j in range(i, i + 10_000))])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 64 * 100_000


def test_encoder_begins_anew(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PARTS", 5)
    monkeypatch.setattr(bpe.text, "PIECE", 200)
    made = [(None, t) for _, t in texts(awkward())] + [(None, " \u3000\nx"), (None, "it's  \n\n'so' \u00a0 5's")]
    e = bpe.BpeEncoder(bpe.tokenizer_path())
    for _ in range(2):
        assert [np.frombuffer(b, e.dtype).tolist() for b in e.encode([t for _, t in made])] == [i[:-1] for i in encoded(made, 0)]


@pytest.mark.parametrize("block", [7, 100, 1 << 20])
def test_separator_scan(spark, block):
    files = write_token_files(frame(spark), ordered=block > 50)
    got = rows_of(count_tokens(files, block_ids=block), "doc_no", "n_tokens", "ended")
    lengths = [len(i) for i in encoded(texts(awkward()), 0, True)]
    assert sorted(n for n, _, _ in got) == list(range(len(lengths)))
    assert sorted(n for _, n, _ in got) == sorted(lengths) and all(e for _, _, e in got)


def test_separator_scan_over_groups_and_open_ends(spark, tmp_path, monkeypatch):
    from tidemark.llm import separator_scan as module

    monkeypatch.setattr(module, "GROUP_BLOCKS", 2)
    ids = np.array([5, 9, 5, 5, 5, 5, 5, 5, 5, 5, 5, 9, 9, 5, 5], "<u2")
    (tmp_path / "x.ids").write_bytes(ids.tobytes())
    (tmp_path / "y.ids").write_bytes(np.array([9], "<u2").tobytes())
    schema = "folder string, part int, file string, n_ids long, id_bytes int"
    files = spark.createDataFrame([(str(tmp_path), 0, "x.ids", 15, 2), (str(tmp_path), 1, "y.ids", 1, 2), (str(tmp_path), 2, "z.ids", 0, 2)], schema)
    got = rows_of(count_tokens(files, 9, 2), "doc_no", "part", "start", "n_tokens", "ended")
    assert got == [(0, 0, 0, 2, True), (1, 0, 2, 10, True), (2, 0, 12, 1, True), (3, 0, 13, 2, False), (4, 1, 0, 1, True)]


def test_separator_scan_of_nothing(nothing):
    assert count_tokens(write_token_files(nothing)).count() == 0


# passages


def test_repeated_passages(docs):
    got = {}
    for r in repeated_passages(docs).collect():
        got.setdefault(r.doc_id, r)
    assert {i for i, r in got.items() if r.n_passages} == {1, 2, 3, 9, 10, 16, None}
    assert got[9].component_id == got[10].component_id == 9 and got[3].component_id == 1
    assert got[9].n_repeated_words == 70 and got[9].n_links == 1
    assert got[11].n_passages == 0 and got[11].component_id == 11


def test_exact_passages_are_all_found(spark):
    import random

    r = random.Random(9)
    shared = [prose(200 + i, r.randrange(50, 90)) for i in range(8)]
    rows = []
    for i in range(60):
        parts = [prose(300 + i, 80)] + [s for s in shared if r.random() < 0.2] + [prose(400 + i, 60)]
        rows.append((i, "\n".join(parts)))
    got = {x.doc_id: x.n_repeated_words for x in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.exact_passages(rows)
    # By chance a word more may agree with a text other than the one it was verified with.
    assert all(got[i] >= n - 3 for i, n in want.items())
    assert {i for i, n in got.items() if n} == {i for i, n in want.items() if n}


def test_a_passage_with_an_inserted_word(spark):
    words = prose(500, 80).split()
    other = words[:40] + ["inserted"] + words[40:]
    rows = [(1, prose(501, 50) + " " + " ".join(words)), (2, " ".join(other) + " " + prose(502, 50)), (3, prose(503, 120))]
    got = {x.doc_id: x.n_passages for x in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 0}


@pytest.mark.parametrize("few", [16, 0])
def test_passages_beside_the_least_text_of_a_key(spark, monkeypatch, few):
    from pyspark.sql import functions as F

    from tidemark.llm import compact_windows as module
    from tidemark.llm.text import text_key

    monkeypatch.setattr(module, "FEW", few)
    shared = [prose(820 + i, 50) for i in range(12)]
    made = []
    for i, s in enumerate(shared):
        # Quotes of 49 words that have the least key, so that no window of theirs is a passage.
        quotes = [f"{prose(900 + 40 * i + j, 60)} {' '.join(s.split()[:49])} {prose(5000 + 40 * i + j, 60)}" for j in range(40)]
        whole = [f"{prose(7000 + 2 * i + j, 60)} {s} {prose(8000 + 2 * i + j, 60)}" for j in range(2)]
        keys = spark.createDataFrame([(x,) for x in [*quotes, *whole]], "text string").select("text", text_key(F.col("text")).alias("k")).collect()
        k = {r.text: r.k for r in keys}
        least = [q for q in quotes if k[q] < min(k[w] for w in whole)][:2]
        made += [(100 * i + j, t) for j, t in enumerate(whole + least)]
    got = {r.doc_id: r for r in repeated_passages(spark.createDataFrame(made, "doc_id long, text string")).collect()}
    assert all(got[d].n_passages == got[d].n_links == 1 and got[d].component_id == d // 100 * 100 for d in got if d % 100 < 2)


def test_links_are_counted_in_a_class(spark):
    rows = [(i, f"{prose(830 + i, 40)} {prose(829, 60)} {prose(840 + i, 40)}") for i in range(4)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.n_links for r in got] == [3] * 4


def test_every_occurrence_within_a_text_is_found(spark):
    rows = []
    for i in range(6):
        p = prose(850 + i, 60)
        rows += [(10 * i, f"{prose(860 + i, 60)} {p} {prose(870 + i, 60)} {p} {prose(880 + i, 60)}"), (10 * i + 1, f"{prose(890 + i, 60)} {p}")]
    # A text that alone repeats a passage holds none that recurs in another row.
    rows.append((100, f"{prose(899, 60)} {prose(898, 60)} {prose(899, 60)}"))
    got = {r.doc_id: (r.n_passages, r.n_repeated_words) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{10 * i: (2, 120) for i in range(6)}, **{10 * i + 1: (1, 60) for i in range(6)}, 100: (0, 0)}


@pytest.mark.parametrize("edit", ["changed", "inserted", "removed"])
def test_a_passage_goes_on_beyond_one_edit(edit):
    from tidemark.llm.compact_windows import passages

    def shingles(words):
        from tidemark.llm.text import mix, shingle_hashes

        return shingle_hashes(mix(np.array([zlib.crc32(w.encode()) for w in words], np.uint64)), 5)[: len(words) - 4]

    words = [f"w{i}" for i in range(52)]
    other = {"changed": [*words[:26], "x", *words[27:]], "inserted": [*words[:26], "x", *words[26:]], "removed": words[:26] + words[27:]}[edit]
    a = [f"a{i}" for i in range(30)] + words + [f"b{i}" for i in range(30)]
    b = [f"c{i}" for i in range(20)] + other + [f"d{i}" for i in range(30)]
    for at, to in ((35, 25), (70, 60 + len(other) - 52)):
        assert passages(shingles(a), shingles(b), [(at, to)]) == [(30, 78, 20, 20 + len(other) - 4)]
    # Two edits are too many for so short a passage.
    other[10] = "y"
    assert passages(shingles(a), shingles([f"c{i}" for i in range(20)] + other), [(70, 60 + len(other) - 52)]) == []


def test_a_run_of_one_word_has_two_windows_a_function(spark):
    from tidemark.llm.compact_windows import HASHES, windows

    alone = spark.createDataFrame([(1, "the " * 3000)], "doc_id long, text string")
    got = windows(alone).collect()
    assert sorted({(r.c, r.run) for r in got}) == [(0, 2995), (2995, -2995)] and len(got) == 2 * HASHES


def test_runs_of_one_word(spark):
    def run(i, word, n):
        return f"{prose(910 + 2 * i, 60)} {' '.join([word] * n)} {prose(911 + 2 * i, 60)}"

    rows = [(1, run(1, "the", 500)), (2, run(2, "the", 70)), (3, run(3, "of", 300)), (4, run(4, "the", 40)), (5, run(5, "the", 30))]
    got = {r.doc_id: (r.n_passages, r.n_repeated_words, r.component_id) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 500, 1), 2: (1, 70, 1), 3: (0, 0, 3), 4: (0, 0, 4), 5: (0, 0, 5)}


def test_runs_of_many_lengths_are_told_apart_at_once(spark):
    from tidemark.llm.compact_windows import first_windows

    rows = [(7, i, 10, 5, i, i) for i in range(20, 45)]
    first = first_windows(spark.createDataFrame(rows, "key long, text_key long, c int, left int, right int, run int")).collect()
    assert [(r.key, r.w.text_key, r.n) for r in first] == [(7, 44, 25)]


def test_a_place_keeps_its_farthest_reach(spark):
    from tidemark.llm.compact_windows import with_widest_reach

    rows = [(k, 1, 5, 0, 0, t, 5, reach, reach, 0) for k, reach in ((1, 10), (2, 40)) for t in (2, 3)]
    apart = spark.createDataFrame(rows, "key long, a long, ca int, la int, ra int, b long, c int, left int, right int, run int")
    assert {(r.key, r.b, r.left, r.right) for r in with_widest_reach(apart).collect()} == {(k, t, 40, 40) for k in (1, 2) for t in (2, 3)}


def test_repeated_passages_of_nothing(nothing):
    assert repeated_passages(nothing).count() == 0


# quality, licenses


def test_base_counts(docs):
    got = rows_of(judge(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for d, t in texts(awkward()):
        c = brute.base_counts(t)
        want.append((d, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert got == sorted(want, key=repr)


def test_odd_distributions_are_rejected(spark):
    plain = [(i, " ".join(x.strip("0123456789") for x in prose(600 + i, 200).split()) + ".", "en", "s", 1) for i in range(30)]
    odd = [(100, " ".join(w + "###" for w in plain[0][1].split()), "en", "s", 1), (101, plain[1][1].upper(), "en", "s", 1), (102, plain[2][1].upper(), None, "s", 1)]
    got = {r.doc_id: r.kept for r in judge(spark.createDataFrame(plain + odd, SCHEMA)).collect()}
    assert {i for i, k in got.items() if not k} == {100, 101, 102}


def test_judge_without_any_language(spark, nothing):
    assert judge(nothing).count() == 0
    row = judge(spark.createDataFrame([(1, prose(1, 90), None, None, 1)], SCHEMA)).first()
    assert row.kept and row.class_distance is None


def test_licenses(spark):
    filler = prose(700, 60)
    cut = TEMPLATES["GPL-3.0-header"].split()
    rows = [(1, f"{filler} {TEMPLATES['MIT']} {filler}"), (2, f"{filler}\n{TEMPLATES['Apache-2.0-header'].upper()}\n"), (3, " ".join(cut[:-3])),
            (4, " ".join(cut[: len(cut) // 2])), (5, None), (6, ""), (7, "Released under the MIT"), (8, filler), (9, TEMPLATES["CC-BY-NC-4.0"] * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [x.name for x in r.licenses] for r in scan_licenses(df).collect()}
    assert got == {1: ["MIT"], 2: ["Apache-2.0", "Apache-2.0-header"], 3: ["GPL-3.0-header"], 4: [], 5: [], 6: [], 7: [], 8: [], 9: ["CC-BY-NC-4.0"]}


@pytest.mark.parametrize("at", range(12))
def test_licenses_at_any_offset(spark, at):
    df = spark.createDataFrame([(1, prose(at, at) + " " + TEMPLATES["MIT"] + " " + prose(at + 50, 31))], "doc_id long, text string")
    assert [x.name for x in scan_licenses(df).first().licenses] == ["MIT"]


def test_only_windows_near_a_wanted_pair_are_hashed(spark):
    import random

    from pyspark.sql import functions as F

    from tidemark.llm.license_scan import _near_starts

    r = random.Random(4)
    rows = [([r.randrange(60) for _ in range(r.randrange(80))],) for _ in range(60)]
    df = spark.createDataFrame(rows, "pairs array<long>")
    got = df.select("pairs", _near_starts(F.col("pairs"), [3, 7], 9).alias("starts")).collect()
    assert all(sorted(x.starts) == [i + 1 for i in range(0, len(x.pairs), 5) if {3, 7} & set(x.pairs[i : i + 9])] for x in got)
    assert df.select(F.size(_near_starts(F.col("pairs"), [], 9)).alias("n")).distinct().first().n == 0


def test_licenses_of_awkward_rows_and_nothing(docs, nothing):
    assert scan_licenses(docs).count() == len(awkward()) and scan_licenses(nothing).count() == 0
    assert scan_licenses(docs, {}).filter("size(licenses) > 0").count() == 0


# languages


LATIN = {"en": "the of and that with this from was", "de": "der die und das mit sich nicht ein", "fr": "le la les des une que est pour"}


def labelled(n=20):
    return [(10 * i + j, " ".join(f"{w}{'x' * (i % 3)}" for w in words.split() * 4), lang, "s", 1) for i in range(n) for j, (lang, words) in enumerate(LATIN.items())]


def test_languages(spark):
    df = spark.createDataFrame(labelled(), SCHEMA)
    model = fit_language_model(df)
    assert model.languages == ["de", "en", "fr"]
    asked = [(1, "The of, and with."), (2, "und nicht"), (3, None), (4, "12 -- 34"), (5, ""), (6, "lesx desx pourxx unex"), (7, "日本")]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["en", "de", "und", "und", "und", "fr"]
    assert got[3].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert got[7].lang_pred == "de" and got[7].score == pytest.approx(1 / 3)


def test_languages_of_awkward_rows(docs, nothing):
    model = fit_language_model(docs)
    got = identify(docs, model)
    assert got.count() == len(awkward()) and set(got.columns) == {*docs.columns, "lang_pred", "score"}
    empty = fit_language_model(nothing)
    assert empty.languages == [] and {r.lang_pred for r in identify(docs, empty).collect()} == {"und"}


# mixing


def test_mix_targets_and_takes(docs):
    got = mix_sources(docs).collect()
    sizes = {}
    for _, t, _, s, _ in sorted(awkward(), key=lambda r: (r[3] is None, r[3] or "")):
        sizes[s] = sizes.get(s, 0) + len(brute.WORD.findall(t or ""))
    target = brute.mix_targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert r.copies <= 3
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    # Rows of one place go together, so two equal rows may be over or short together.
    assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in sizes)
    again = sorted((repr(r.doc_id), r.text_key, r.copies) for r in mix_sources(docs).collect())
    assert again == sorted((repr(r.doc_id), r.text_key, r.copies) for r in got)


def test_mix_comes_near_with_many_rows(spark):
    rows = [(i, prose(i, 5 + i % 17), "en", f"s{i % 4}" if i % 5 else "hot", 1) for i in range(900)]
    by = {}
    for r in mix_sources(spark.createDataFrame(rows, SCHEMA)).collect():
        by.setdefault(r.source, [r.target, 0])[1] += r.size * r.copies
    assert all(abs(taken - target) <= 11 for target, taken in by.values())


def test_mixed_rows(docs, nothing):
    counts = {(r.doc_id, r.text_key): r.copies for r in mix_sources(docs).collect()}
    out = mixed(docs)
    assert out.columns == docs.columns
    pairs = [(r.doc_id, r.text_key) for r in mix_sources(docs).collect()]
    assert out.count() == sum(counts[p] for p in pairs)
    assert mixed(nothing).count() == 0 and mix_sources(nothing).count() == 0


def test_words_are_many():
    assert len(set(WORDS)) > 40
