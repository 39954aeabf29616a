"""Clustering, manifest and piece codec against plain versions."""

import hashlib
import math
import random
import re
import time
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
from debutline.llm import cuts, digest, html_extract, incremental_means, manifest, mix, piece_codec, token_file
from debutline.llm.queries import tokenizer_path
from debutline.llm.shared import picked
from pyspark.sql import functions as F
from tokenizers import Tokenizer

MODEL = "piece_bpe_32k.model"


# --- pieces ---------------------------------------------------------------------------------------


def some_texts(count, seed=1):
    rng = random.Random(seed)
    letters = "ab  e th in ▁é中\n\t😀ß́ ,.'\x00<s>0xA"
    fixed = ["", " ", "  ", "▁", "▁ ", "</s>", "<0x41>", "word", " word ", "\n"]
    return fixed + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(count)]


def by_library(texts):
    library = piece_codec.library(tokenizer_path(MODEL))
    ids = library.encode(texts, add_bos=True, add_eos=True)
    return [array("I", row).tobytes() for row in ids], [library.decode(row) for row in ids]


@pytest.mark.parametrize("window", [7, 1 << 20])
def test_codec_equals_the_library(monkeypatch, window):
    monkeypatch.setattr(cuts, "WINDOW", window)
    texts = some_texts(1500)
    codec = piece_codec.PieceCodec(tokenizer_path(MODEL))
    rows = codec.encode(texts)
    assert (rows, [text.decode() for text in codec.decode(rows)]) == by_library(texts)
    assert codec.encode([None]) == codec.encode([""]) and codec.encode([]) == []


def test_codec_forgets_and_starts_again():
    texts = some_texts(400, 2)
    codec = piece_codec.PieceCodec(tokenizer_path(MODEL), most=20)
    assert codec.encode(texts[:200]) + codec.encode(texts[200:]) == by_library(texts)[0]


def test_cuts_with_one_hash_are_told_apart(monkeypatch):
    found = cuts.Cuts.hashes
    # as if all first hashes of the first factors were equal
    monkeypatch.setattr(cuts.Cuts, "hashes", lambda self, *a: (found(self, *a)[0] * np.uint64(self.factor != cuts.FACTORS[0]) + np.uint64(self.factor == cuts.FACTORS[0]), found(self, *a)[1]))
    texts = some_texts(50, 3)
    assert piece_codec.PieceCodec(tokenizer_path(MODEL)).encode(texts) == by_library(texts)[0]


def test_decoding_of_any_ids():
    rng = random.Random(4)
    rows = [[rng.choice([rng.randrange(32000), rng.randrange(3, 260), 0, 1, 2, 28705]) for _ in range(rng.randint(0, 12))] for _ in range(3000)]
    codec, library = piece_codec.PieceCodec(tokenizer_path(MODEL)), piece_codec.library(tokenizer_path(MODEL))
    assert [text.decode() for text in codec.decode([array("I", row).tobytes() for row in rows])] == [library.decode(row) for row in rows]


def test_agenda_takes_the_best_score_then_the_leftmost():
    # "bc" before "ab": a better score; of two equal ones the left
    assert piece_codec.merged("abc", {"ab": 2.0, "bc": 1.0}) == ["a", "bc"]
    assert piece_codec.merged("aaa", {"aa": 1.0}) == ["aa", "a"]
    assert piece_codec.merged("aaaa", {"aa": 1.0, "aaaa": 5.0}) == ["aaaa"]


def test_piece_round_trip_of_rows(spark):
    texts = [*some_texts(30, 5), "long text without end " * 20_000, "x" * 30_000]
    rows = [(k, text.replace("\x00", "0"), f"n{k}") for k, text in enumerate(texts)] + [(None, None, "a"), (3, "twice", "b"), (3, "twice", "b")]
    given = spark.createDataFrame(rows, "doc_id long, text string, _id string").repartition(3)
    got = piece_codec.round_trip(given, tokenizer_path(MODEL), keep=True).collect()
    ids, decoded = by_library([row[1] or "" for row in rows])
    want = [(r[0], r[2], len(i) // 4, hashlib.sha256(i).hexdigest(), hashlib.sha256(d.encode()).hexdigest(), i, d) for r, i, d in zip(rows, ids, decoded)]
    key = lambda r: (str(r[0]), r[3])
    assert sorted([(r[0], r[1], *r[2:5], bytes(r[5]), r[6]) for r in got], key=key) == sorted(want, key=key)
    assert piece_codec.round_trip(given.limit(0), tokenizer_path(MODEL)).count() == 0
    with pytest.raises(ValueError, match="_n_tokens"):
        piece_codec.round_trip(given.withColumn("_n_tokens", F.lit(1)), tokenizer_path(MODEL))


# --- word ids -------------------------------------------------------------------------------------


@pytest.mark.parametrize("file, apart", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_ids_of_both_public_tokenizers(file, apart):
    path = tokenizer_path(file)
    rng = random.Random(6)
    letters = "abcdeABSTst  '' .,|<>!-_0123\n\té\u0301\u030cJΣσß中İ  x"
    bits = ["don't", "I'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "it.'s", "<|startoftext|>", "1\u0301", "J\u030c", "\x1c", "\x85", "||", "12'3"]
    texts = ["", " "] + ["".join(rng.choice(letters) if rng.random() < 0.85 else rng.choice(bits) for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert token_file.splits_words(path) == apart
    assert [ids.tolist() for ids in token_file.WordIds(path).closed(texts)] == [[*code.ids, 1] for code in want]


# --- manifest -------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(values):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def proofs_by_hand(leaves, fanout):
    """(root, levels of siblings of each leaf as (before, after) lists)"""
    ways, places, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k, at in enumerate(places):
            first = at // fanout * fanout
            ways[k].append((level[first:at], level[at + 1 : first + fanout]))
            places[k] = at // fanout
        level = [sha(*level[at : at + fanout]) for at in range(0, len(level), fanout)]
    return level[0], ways


def manifest_by_hand(rows, fanout):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for rows_of in groups.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_hand(r)))
    below = {g: proofs_by_hand([leaf_by_hand(r) for r in groups[g]], fanout) for g in order}
    root, above = proofs_by_hand([below[g][0] for g in order], fanout)
    out = []
    for g, way_up in zip(order, above):
        for row, way in zip(groups[g], below[g][1]):
            whole = way + way_up
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            text = row[4] if row[4] is None or not bad else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            folded = leaf_by_hand((*row[:4], text))
            for before, after in whole:
                folded = sha(*before, folded, *after)
            proof = sha(*[digest for before, after in whole for digest in before + after])
            out.append((row[0], leaf_by_hand(row), below[g][0], root, proof, folded, folded == root))
    return out


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def manifest_of(spark, rows, fanout, levels):
    given = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("_block", F.lit("other"))
    bad = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = manifest.manifest(given, FIELDS, tampered=bad, fanout=fanout, block_levels=levels)
    return sorted([tuple(r) for r in found.collect()], key=str)


@pytest.mark.parametrize("fanout, levels", [(2, 1), (3, 1), (16, 3), (4, 2)])
def test_manifest_equals_a_plain_tree(spark, fanout, levels):
    rng = random.Random(fanout)
    rows = []
    # sizes about powers of the fanout and a group with a third of all rows
    for source, size in (("hot", 61), ("a", 1), ("b", 2), ("é", 9), (None, 17), ("c", 27), ("", 28), ("d", 33)):
        rows += [(rng.randrange(10**6), source, rng.choice(["en", None]), k, rng.choice(["Text A", "ÄZ", "", None, "low"])) for k in range(size)]
    rows += [(None, "a", None, None, None), (7, "b", "en", 1, "X"), (7, "b", "en", 1, "X"), (7, "b", "en", 1, "Y"), (5, None, None, None, "Q" * 50_000)]
    got = manifest_of(spark, rows, fanout, levels)
    assert got == sorted(manifest_by_hand(rows, fanout), key=str)
    assert any(not row[-1] for row in got)


def test_manifest_of_one_row_and_of_none(spark):
    row = (1, "s", "en", 4, "Text")
    assert manifest_of(spark, [row], 16, 3) == manifest_by_hand([row], 16)
    assert manifest_of(spark, [], 16, 3) == []
    with pytest.raises(ValueError, match="_leaf"):
        manifest.manifest(spark.createDataFrame([row], SCHEMA).withColumnRenamed("lang", "_leaf"), ["doc_id", "_leaf"])


# --- clustering -----------------------------------------------------------------------------------


def clusters_by_hand(rows, dimensions, centroids, rounds, scale=256):
    kept = []
    for name, vector in rows:
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((name, vector, [math.floor(scale * float(np.float32(x))) for x in vector]))
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"2:{r[0]}"), r[1]))[:centroids]
    centres = [list(r[2]) for r in first]
    for turn in range(rounds + 1):
        away = [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres)) for _, _, v in kept]
        if turn < rounds:
            for k in range(len(centres)):
                own = [v for (_, _, v), (_, place) in zip(kept, away) if place == k]
                if own:
                    centres[k] = [sum(column) // len(own) for column in zip(*own)]
    of = defaultdict(int)
    for d, k in away:
        of[k] += d
    return [(name, k, d, of[k], sum(of.values()), sha(",".join(map(str, centres[k])))) for (name, _, _), (d, k) in zip(kept, away)]


def clusters_of(spark, rows, **options):
    given = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).withColumn("ids", F.lit(1))
    return sorted([tuple(r) for r in incremental_means.cluster(given, **options).collect()], key=str)


@pytest.mark.parametrize("spread", [0.02, 3.0])
def test_clusters_equal_a_plain_version(spark, spread):
    rng = random.Random(8)
    rows = [(k, [rng.gauss(k % 4, spread) for _ in range(6)]) for k in range(90)]
    rows += [(200 + k, [0.5] * 6) for k in range(60)] + [(300, [0.25] * 6)] * 3  # copies, repeated rows
    rows += [(400, None), (401, []), (402, [1.0] * 5), (403, [1.0, None] * 3), (404, [float("nan")] * 6), (405, [float("inf")] * 6), (None, [1.0] * 6)]
    got = clusters_of(spark, rows, dimensions=6, centroids=7, rounds=4)
    assert got == sorted(clusters_by_hand(rows, 6, 7, 4), key=str)


def test_few_and_no_and_wide_vectors(spark):
    two = [(1, [1.0, 2.0]), (2, [1.0, 2.0])]
    assert clusters_of(spark, two, dimensions=2, centroids=5, rounds=2) == sorted(clusters_by_hand(two, 2, 5, 2), key=str)
    assert clusters_of(spark, [(1, None)], dimensions=2) == [] and clusters_of(spark, [], dimensions=2) == []
    wide = clusters_of(spark, [*two, (3, [1e30, 0.0])], dimensions=2, centroids=5, rounds=2)
    assert wide == sorted([*clusters_by_hand(two, 2, 5, 2), (3, None, None, None, None, None)], key=str)
    assert clusters_of(spark, [(3, [1e30, 0.0])], dimensions=2) == [(3, None, None, None, None, None)]


def test_mended_products_equal_fresh_ones():
    rng = np.random.default_rng(3)
    for top in (50, 1 << 27):
        vectors, before = rng.integers(-top, top, (40, 8)), rng.integers(-top, top, (5, 8))
        after = before.copy()
        after[0] += 1  # all components
        after[2, 3] -= 7  # one component
        dots = incremental_means.products(vectors, before)
        incremental_means.mend(dots, vectors, after - before)
        want = [[sum(int(a) * int(b) for a, b in zip(v, c)) for c in after] for v in vectors]
        assert dots.tolist() == want


# --- helpers of earlier operators -----------------------------------------------------------------


def test_picked_rows_keep_columns_of_any_name(spark):
    rows = [(1, "a", 7, "x", 5), (1, "a", 8, "y", 5), (2, "b", 9, "z", 6), (3, None, 1, "w", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hash long, _times string, _row int").repartition(3)
    chosen = docs.groupBy("doc_id", F.xxhash64("text").alias("_hash")).agg(F.count("*").alias("_rows")).withColumn("_times", F.when(F.col("doc_id") == 1, 2).otherwise(1))
    got = sorted(tuple(r) for r in picked(docs, chosen, "text", ["doc_id"]).collect())
    again = sorted(tuple(r) for r in picked(docs.repartition(1), chosen, "text", ["doc_id"]).collect())
    # of rows alike in id and text one is taken, the same on every run, as often as it is asked for
    assert got == again and got[0] == got[1] and got[0] in rows[:2] and got[2:] == rows[2:]


def test_mix_of_alike_rows_is_cut_into_blocks(spark):
    rows = [(None, "s", "one two three")] * 10_000 + [(k, "t", "word " * (1 + k % 7)) for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    units = mix.drawn(
        docs.select(F.col("doc_id").alias("key"), "source", mix.word_count("text").alias("size")),
        mix.source_targets(docs.select("source", mix.word_count("text").alias("size"))), block_units=500,
    )
    assert units.count() == len(rows)
    got = {r["target"]: r["taken"] for r in mix.mix(docs, block_units=500).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()}
    assert all(abs(taken - target) <= 6 for target, taken in got.items())
    assert sorted(map(tuple, mix.mix(docs, block_units=500).collect()), key=str) == sorted(map(tuple, mix.mix(docs.repartition(2), block_units=500).collect()), key=str)


def test_text_ids_are_refused_by_name(spark):
    with pytest.raises(ValueError, match="whole numbers"):
        digest.with_next(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


# --- plain versions of earlier operators ----------------------------------------------------------


def digest_by_hand(data):
    counts = [0] * digest.BUCKETS
    for number, places in enumerate(((0, 1, 2), (0, 1, 3), (0, 2, 3))):
        for at in range(len(data) - places[2]):
            mixed = 0
            for k, place in enumerate(places):
                mixed ^= int(digest._TABLES[3 * number + k][data[at + place]])
            counts[mixed % 128] += 1
    ranked = sorted(counts)
    q1, q2, q3 = ranked[31], ranked[63], ranked[95]
    ratio = lambda q: min(q * 15 // max(q3, 1), 15)
    out = [min(round(math.log2(len(data) + 1) * 8), 255), ratio(q1) * 16 + ratio(q2)]
    for at in range(0, 128, 4):
        byte = 0
        for c in counts[at : at + 4]:
            byte = byte * 4 + (c > q1) + (c > q2) + (c > q3)
        out.append(byte)
    return bytes(out)


def likeness_by_hand(a, b):
    score = min(abs(a[0] - b[0]), 16) + min(abs((a[1] >> 4) - (b[1] >> 4)) + abs((a[1] & 15) - (b[1] & 15)), 16)
    for one, other in zip(a[2:], b[2:]):
        for shift in (0, 2, 4, 6):
            score += (0, 1, 2, 4)[abs((one >> shift & 3) - (other >> shift & 3))]
    return 1 - score / (32 + 4 * 128)


def test_digests_and_likeness_by_hand():
    rng = random.Random(7)
    texts = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 3, 4, 50, 900]))) for _ in range(40)] + [b"word " * 300, b"\xff" * 70]
    rows = digest.digests(texts)
    assert [row.tobytes() for row in rows] == [digest_by_hand(text) for text in texts]
    pairs = [(rng.randrange(len(texts)), rng.randrange(len(texts))) for _ in range(200)]
    got = digest.likeness(rows[[a for a, _ in pairs]], rows[[b for _, b in pairs]])
    assert np.allclose(got, [likeness_by_hand(rows[a].tolist(), rows[b].tolist()) for a, b in pairs])


def test_next_documents_with_repeated_ids_by_hand(spark):
    rows = [(5, "five five five"), (5, "five five five"), (4, "four"), (4, None), (-3, ""), (None, "no id at all"), (2**40, "ab" * 40)]
    got = digest.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), parts=4).collect()
    texts = {name: [t or "" for n, t in rows if n == name] for name, _ in rows}
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(n) for n, _ in rows)
    # the order of equal ids is that of a hash, so either neighbour may follow
    after = {2**40: texts[5], 5: texts[5] + texts[4], 4: texts[4] + texts[-3], -3: texts[None], None: texts[2**40]}
    for r in got:
        ways = set()
        for own in texts[r["doc_id"]]:
            for following in after[r["doc_id"]]:
                cut = len(own) // 3
                edited = own[: len(own) - cut] + following[:cut]
                a, b, c = (digest_by_hand(t.encode()) for t in (own, edited, following))
                ways.add((len(own), hashlib.sha256(edited.encode()).hexdigest(), a.hex(), b.hex(), round(likeness_by_hand(a, b), 9), round(likeness_by_hand(a, c), 9)))
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) in ways


# --- main texts -----------------------------------------------------------------------------------

STORY = "<p>The first paragraph of the story is long enough to be read, with commas, and full stops.</p><p>Another one follows here, which tells more about it all, and ends the story well.</p>"
STORY_TEXT = "\n\n".join(part[3:] for part in STORY.split("</p>") if part)
CASES = {
    "bare lines around": (f"<body>Skip to content <article><h1>Title here</h1>{STORY}</article> Copyright 2024 Some Company</body>", f"Title here\n\n{STORY_TEXT}"),
    "an aside inside": (f"<body><article><h1>Title here</h1>{STORY}<aside>Related: other story</aside>{STORY}</article></body>", f"Title here\n\n{STORY_TEXT}\n\n{STORY_TEXT}"),
    "unnamed comments": (f"<body><article><h1>Title here</h1>{STORY}</article><div><h3>Comments</h3><div><b>Bob</b><p>Nice story, thanks for it.</p></div></div></body>", f"Title here\n\n{STORY_TEXT}"),
}


@pytest.fixture(scope="module")
def forest(spark):
    return html_extract.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("name", list(CASES))
def test_main_text_of_pages_by_the_contract(forest, name):
    source, want = CASES[name]
    assert html_extract.main_texts([source], forest) == [want]


def test_articles_without_any_wrapper(spark, forest):
    pages = [row[0] for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    inner = [re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1] for page in pages]
    named = html_extract.main_texts([f"<body><article>{part}</article></body>" for part in inner], forest)
    bare = html_extract.main_texts([f"<body>{part}</body>" for part in inner], forest)
    framed = html_extract.main_texts([f"<body><nav><a href='/a'>Home</a></nav>{part}<footer>Copyright of the site</footer></body>" for part in inner], forest)
    for found in (bare, framed):
        assert all(found) and sum(a == b for a, b in zip(found, named)) >= 0.9 * len(pages), sum(a == b for a, b in zip(found, named)) / len(pages)


def test_runs_of_text_are_elements_of_their_own():
    page = html_extract.parse("<div>one <b>two</b> three<p>four</p> <p>five <i>six</i></p>seven<hr>eight</div>")
    runs = [k for k, tag in enumerate(page.tag) if tag == html_extract.RUN]
    texts = {k: "".join(text for node, text in page.events if node == k or page.parent[node] == k) for k in runs}
    assert [texts[k] for k in runs] == ["one two three", "four", "five six", "seven", "eight"]
    assert all(page.parent[k] < k for k in range(1, len(page.tag)))
    rows, _ = html_extract.features(page)
    # a paragraph's own run goes with it
    assert [page.tag[k] for k in rows] == ["div", html_extract.RUN, "p", "p", html_extract.RUN, html_extract.RUN]
    assert html_extract.text_of(page, [True] * len(page.tag)) == "one two three\n\nfour\n\nfive six\n\nseven\n\neight"


@pytest.mark.parametrize("tag", ["div", "b", "li"])
def test_deeply_nested_tags_take_linear_time(forest, tag):
    source = f"<{tag}>" * 100_000 + "deep" + "</p></em></li></td>" * 25_000
    begun = time.perf_counter()
    assert len(html_extract.parse(source).tag) > 100_000
    assert time.perf_counter() - begun < 10
