"""The methods of the training-data operators against brute force, on small data with awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from debutline.llm import components, decontaminate, digest, html_extract, language, mix, quality, simhash, token_counts, token_file, warc
from debutline.llm.queries import SQL, tokenizer_path
from debutline.llm.shared import numbered

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, size string, _other int").repartition(3)


def plain(rows):
    """Rows with extra columns whose names the operators use elsewhere."""
    return [(i, t, "x", 1) for i, t in rows]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = ["a", "b", "Cé", "dd", "9", "of", "the"]
    made = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 50)))) for k in range(150)]
    long_text = " ".join(rng.choice(words) for _ in range(30_000))
    return made + [(150, None), (151, ""), (152, " \n\t"), (None, "a b c"), (153, "a b"), (153, "a b"), (154, long_text), (155, long_text + " tail")]


# --- decontamination


def windows_by_hand(rows, items, window):
    out = []
    for name, text in rows:
        words, hit, held = WORD.findall(lowered(text)), set(), set()
        for item, test in items:
            test = WORD.findall(lowered(test))
            size = min(window, len(test))
            for start in range(len(test) - size + 1 if test else 0):
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == test[start : start + size]:
                        hit |= set(range(at, at + size))
                        held.add(str(item))
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        out.append((name, len(words), len(hit), len(held), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window, block_words, shard_bytes", [(4, 10**6, 1 << 20), (6, 40, 300), (13, 10**6, 64)])
def test_windows_are_found(spark, texts, window, block_words, shard_bytes):
    rng = random.Random(5)
    rows = [row for row in texts if row[0] != 154 and row[0] != 155] + [(200, "x " * 300 + "of the of the dd dd a 9 b of the a Cé end")]
    items = [(k, ", ".join(rng.choice(["a", "b", "Cé", "dd", "9", "of", "the"]) for _ in range(rng.randint(0, 9)))) for k in range(40)]
    items += [(99, None), (100, ""), (7, "a b"), (101, "OF THE of the dd dd a 9 b of the a Cé end and more")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_windows(docs(spark, plain(rows)), bench, window=window, block_words=block_words, shard_bytes=shard_bytes)
    assert {"size", "_other"} <= set(found.columns)
    got = sorted((tuple(row) for row in decontaminate.judged(found.select("doc_id", "_n_words", "_spans", "_items")).collect()), key=str)
    assert got == windows_by_hand(rows, items, window)


@pytest.mark.parametrize("block_words", [10**6, 8])
def test_items_without_an_id_are_searched(spark, block_words):
    rows = [(1, "a b c d e f"), (2, "x y z and w"), (3, "a b c x y z"), (4, "q")]
    items = [(None, "a b c"), (7, "d e f"), (None, "x y z"), (8, None), (None, "")]
    given = docs(spark, plain(rows)), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.judged(decontaminate.find_windows(*given, block_words=block_words).select("doc_id", "_n_words", "_spans", "_items")).collect())
    con = duckdb.connect()
    for name, held in (("documents(doc_id BIGINT, text VARCHAR)", rows), ("benchmark(item_id BIGINT, text VARCHAR)", items)):
        con.execute(f"CREATE TABLE {name}")
        con.executemany(f"INSERT INTO {name.split('(')[0]} VALUES (?, ?)", held)
    assert got == sorted(con.execute(SQL["op5_decontaminate"]).fetchall())
    assert [row[1:4] for row in got] == [(6, 6, 2), (5, 3, 1), (6, 6, 1), (1, 0, 0)]
    assert [r["doc_id"] for r in decontaminate.remove_contaminated(*given, block_words=block_words).collect()] == [4]


def test_wide_items_are_cut(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_VOCABULARY", 20)
    rng = random.Random(8)
    wide, narrow = [f"w{rng.randint(0, 70)}" for _ in range(200)], ["a b c d", "w1 w2"]
    rows = [(k, " ".join([*wide[k * 9 : k * 9 + 14], "z", *wide[k : k + 5]])) for k in range(21)] + [(50, " ".join(wide)), (51, "a b c d")]
    items = [(1, narrow[0]), (2, " ".join(wide)), (3, narrow[1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontaminate.item_blocks(bench, "item_id", "text", 5, 10**6))
    assert max(len(block.vocabulary) for block in blocks) <= 20
    found = decontaminate.find_windows(docs(spark, plain(rows)), bench, window=5)
    got = sorted((tuple(row) for row in decontaminate.judged(found.select("doc_id", "_n_words", "_spans", "_items")).collect()), key=str)
    assert got == windows_by_hand(rows, items, 5)
    with pytest.raises(ValueError, match="distinct words"):
        decontaminate.longest_matches(docs(spark, plain(rows)), bench)


def test_longest_matches(spark):
    rows = plain([(1, "x one two three four y"), (2, "two three four five"), (3, None)])
    bench = spark.createDataFrame([(1, "zero one two three four five"), (2, "")], "item_id long, text string")
    got = {(r["item_word"], r["n_words"], r["doc_id"], r["doc_word"]) for r in decontaminate.longest_matches(docs(spark, rows), bench).collect()}
    assert got == {(1, 4, "1", 1), (2, 4, "2", 0), (3, 3, "2", 1), (4, 2, "2", 2), (5, 1, "2", 3)}


def test_empty_tables_for_windows(spark):
    none = docs(spark, []).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_windows(none, bench).count() == 0
    assert decontaminate.remove_contaminated(docs(spark, plain([(1, "a b"), (2, None)])), bench).count() == 2


# --- SimHash


def print_by_hand(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered(text)) if w]
    runs = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups_by_hand(rows):
    prints = [(name, print_by_hand(text)) for name, text in rows]
    root = {p: p for _, p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if bin(a ^ b).count("1") <= 3:
                root[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for name, p in prints:
        if name is not None:
            least[top(p)] = min(least.get(top(p), name), name)
    return sorted(((name, f"{p:016x}", least.get(top(p))) for name, p in prints), key=str)


def test_near_duplicates(spark, texts):
    rows = texts + [(300 + k, "one two three four five six seven eight nine ten " * 20 + f"w{k}") for k in range(30)] + [(900, "A  B\nC")]
    got = simhash.near_duplicates(docs(spark, plain(rows)), block=16, sample_every=1, leaf_sample=4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == groups_by_hand(rows)
    kept = simhash.keep_one(docs(spark, plain(rows)))
    assert kept.columns == ["doc_id", "text", "size", "_other"]
    assert kept.count() == len({(component, "") if component is not None else p for _, p, component in groups_by_hand(rows)})


def test_trees_bring_every_near_pair_together():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 1500, dtype=np.uint64) * np.uint64(2)
    near = base[:700].copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
    ball = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    every = np.unique(np.concatenate([base, near, ball]))
    pairs = {(int(a), int(b)) for a in range(len(every)) for b in np.flatnonzero(simhash.distance(every, every[a]) <= 3) if a < b}
    met = set()
    for half in (0, 1):
        tree = simhash.grow(every, half, leaf_sample=8)
        rows, leaf, home = tree.deal(every)
        assert home.sum() == len(every)
        for node in np.unique(leaf):
            inside, live = rows[leaf == node], home[leaf == node]
            for a in inside[live]:
                met |= {(min(int(a), int(b)), max(int(a), int(b))) for b in inside}
    assert pairs <= met


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(230)] + [(5, 5), (None, 3)] + [(1000 + k, 1001 + k) for k in range(60)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None:
            root[max(top(a), top(b))] = min(top(a), top(b))
    got = {(r["node"], r["root"]) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(x, top(x)) for x in root if top(x) != x}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_tables_for_prints(spark):
    assert simhash.near_duplicates(docs(spark, []).limit(0)).count() == 0


# --- mixing


def test_targets(spark):
    rows = [("b", 10), ("a", 100), (None, 50), ("c", 1), ("c", 0), ("z", 0)]
    got = {r["source"]: (r["units"], r["source_size"], r["target"]) for r in mix.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    # in order a b c z null with weights 1 2 3 1 2: c stops at 3, z at 0, b at 30; 128 is left for a (1) and null (2)
    assert got == {"a": (1, 100, pytest.approx(128 / 3)), "b": (1, 10, 30.0), "c": (2, 1, 3.0), "z": (1, 0, 0.0), None: (1, 50, pytest.approx(256 / 3))}


def test_mix(spark):
    rng = random.Random(2)
    rows = [(k, "w " * rng.choice([0, 1, 5, 40, 200, 3000 if k % 50 == 0 else 3]), f"s{min(k % 9, 5)}" if k % 7 else None) for k in range(3000)] + [(5, None, "s1"), (None, "a b", "s2"), (6, "a", "s3"), (6, "a", "s3")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("repeats", F.lit(1)).withColumn("units", F.lit("x"))
    got = mix.mix(table.repartition(4), block_units=64, spread=4).toPandas()
    again = mix.mix(table.repartition(7), block_units=64, spread=4).toPandas()
    order = ["doc_id", "size", "target", "taken"]
    assert got.sort_values(order)[order].reset_index(drop=True).equals(again.sort_values(order)[order].reset_index(drop=True))
    assert len(got) == len(rows) and (got.taken <= 3 * got["size"]).all() and (got.taken == got.repeats * got["size"]).all()
    for (target, source_size), part in got.groupby(["target", "source_size"]):
        assert part["size"].sum() == source_size
        assert abs(part.taken.sum() - target) <= part["size"].max() / 2  # some sources are a few long texts
    whole = mix.mixed(table, block_units=64, spread=4)
    seen = whole.select("doc_id", F.coalesce(F.regexp_count("text", F.lit("w|a|b")), F.lit(0)).alias("n")).toPandas()
    assert whole.columns == table.columns and seen.n.sum() == got.taken.sum()
    assert seen.doc_id.value_counts().to_dict() == {k: n for k, n in got.groupby("doc_id").repeats.sum().items() if n > 0}
    assert mix.mixed(table.limit(0)).count() == 0


def test_flight_keeps_the_totals():
    rng = np.random.default_rng(0)
    sizes, shares = rng.integers(0, 5000, 400), np.full(400, 0.37)
    out = mix.flight(shares, sizes, iter(lambda: float(rng.random()), None), np.arange(400))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(shares.sum()) and (out * sizes).sum() == pytest.approx((shares * sizes).sum())


# --- token files


def test_words_are_encoded_as_whole_texts(texts):
    path = tokenizer_path("word_bpe_49k.json")
    rng, letters = random.Random(1), "abÉé \t\n\x0b\x1c\x85\xa0 İßΣσς'sIt's 12½, Ώé <|endoftext|> 中文😀‍!?.X<|ENDoftext|>"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(800)] + [t or "" for _, t in texts]
    made += [row[0] for row in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    want = Tokenizer.from_file(path).encode_batch(made, add_special_tokens=False)
    assert [ids.tolist() for ids in token_file.WordIds(path, 50).encode(made)] == [code.ids for code in want]


def test_ids_do_not_depend_on_words_met_before():
    path = tokenizer_path("word_bpe_49k.json")
    words = token_file.WordIds(path)
    for text in ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>.", "j\u030c", "J\u030c", "J\u030cx!", "don't", "DON'T", "Don't."]:
        assert words.encode([text])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size, symbols", [(0, 1), (1, 1), (2, 2), (700, 3), (20_000, 900), (60_000, 30_000)])
def test_code_round_trip(size, symbols):
    ids = (np.random.default_rng(4).zipf(1.2, size) % symbols).astype(np.int64)
    lengths = token_file.code_lengths(dict(zip(*(x.tolist() for x in np.unique(ids, return_counts=True)))))
    assert lengths.max(initial=0) <= 16 and sum(2.0 ** -int(n) for n in lengths if n) <= 1
    bits, marks = token_file.encode(ids, token_file.canonical(lengths), lengths, 100)
    decoder = token_file.Decoder(lengths)
    for found in decoder.decode([(size, bits, marks)] * 3, 100):
        assert (found == ids).all()


def test_lengths_are_best_without_a_tight_limit():
    import heapq

    counts = {k: int(c) for k, c in enumerate(np.random.default_rng(2).integers(1, 1000, 300))}
    heap, cost = sorted(counts.values()), 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    lengths = token_file.code_lengths(counts)
    assert sum(counts[k] * int(lengths[k]) for k in counts) == cost


def test_token_table(spark, texts):
    path = tokenizer_path("word_bpe_49k.json")
    tokenizer, want, start = Tokenizer.from_file(path), [], 0
    ordered = sorted(texts, key=lambda r: (r[0] is None, r[0] or 0))
    for name, text in ordered:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((name, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = token_file.token_table(docs(spark, plain(texts)), path, block_ids=500, stride=32)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert token_file.token_table(docs(spark, []).limit(0), path).count() == 0


# --- token counts


def test_counts_of_the_best_segmentation(spark):
    scores, byte = token_counts.zipf_scores(["a", "ab", "b", "abc", "c", "bca", "▁a", "▁"]), -9.0

    def best(word):
        ways = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            size = len(word[end - 1].encode())
            found = (ways[end - 1][0] + size * byte, ways[end - 1][1] - size)
            for start in range(end):
                if word[start:end] in scores:
                    found = max(found, (ways[start][0] + scores[word[start:end]], ways[start][1] - 1))
            ways.append(found)
        return -ways[-1][1]

    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcé▁") for _ in range(rng.randint(0, 9))) for _ in range(2000)})
    assert token_counts.word_counts(words, token_counts.backward_trie(scores), byte) == [best(word) for word in words]
    path = tokenizer_path("piece_bpe_32k.model")
    rows = plain([(1, None), (2, ""), (3, " \n"), (4, "the the 😀"), (4, "the the 😀")])
    got = [(r["doc_id"], r["_words"], r["_tokens"]) for r in token_counts.count_tokens(docs(spark, rows), path).orderBy("doc_id").collect()]
    one = token_counts.word_counts(["▁the"], *token_counts.pieces(path))[0]
    assert got[:3] == [(1, 0, 0), (2, 0, 0), (3, 0, 0)] and got[3] == got[4] and got[3][1] == 3 and got[3][2] > 2 * one


# --- digests


@pytest.mark.parametrize("parts", [1, 5])
def test_next_documents(spark, texts, parts):
    def name(row):
        return (row[0] is None, -(row[0] or 0))

    rows = [row for row in texts if row[0] != 153]
    ordered = sorted(rows, key=name)
    want = []
    for k, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own, new, following = digest.digests([text.encode(), edited.encode(), after.encode()])
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.tobytes().hex(), new.tobytes().hex(), digest.likeness(own[None], new[None])[0], digest.likeness(own[None], following[None])[0]))
    got = digest.with_next(docs(spark, plain(rows)), parts=parts)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert digest.with_next(docs(spark, []).limit(0)).count() == 0
    one = digest.with_next(docs(spark, plain([(1, "abcdef")]))).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()


def test_likeness_is_bounded():
    rng = np.random.default_rng(3)
    made = digest.digests([bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 2, 3, 50, 5000, 200_000)])
    pairs = np.array([(a, b) for a in range(7) for b in range(7)])
    value = digest.likeness(made[pairs[:, 0]], made[pairs[:, 1]])
    assert (value >= 0).all() and (value <= 1).all() and (value[pairs[:, 0] == pairs[:, 1]] == 1).all()


# --- classifiers


def test_language(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(given.where(language.learnable("doc_id")), train_rows=600, landmarks=64)
    found = language.predict(given, model).where(~language.learnable("doc_id"))
    held = found.select(F.avg((F.col("lang") == F.col("_lang")).cast("int"))).first()[0]
    assert held >= 0.97
    rows = plain([(1, None), (2, ""), (3, "12 - 34 !"), (4, "The rest of the other things"), (5, "ß")])
    got = {r["doc_id"]: (r["_lang"], r["_score"]) for r in language.predict(docs(spark, rows), model).collect()}
    assert all(got[k] == ("und", 0.0) for k in (1, 2, 3)) and got[4][0] == "en" and got[5][0] != "und"
    assert all(0 <= score <= 1 for _, score in got.values())
    empty = language.fit(given.limit(0))
    assert language.predict(docs(spark, rows), empty).where("_lang <> 'und'").count() == 0


def test_kernel_is_shared_ngrams():
    a, b = (np.frombuffer(t, np.uint8) for t in (b"abcab", b"abd"))
    rows = language.presence(np.concatenate([a, b]), np.array([0] * 5 + [1] * 3), 2)
    grams = lambda t: {t[k : k + n] for n in range(1, 5) for k in range(len(t) - n + 1)}
    assert rows[0].sum() == len(grams(b"abcab")) and rows[0] @ rows[1] == len(grams(b"abcab") & grams(b"abd"))


def test_quality(spark):
    folder = "/root/testdata/sf0.01"
    given, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    weights = quality.fit(quality.labelled_rows(given, labels))
    found = quality.score(given, weights).where(~quality.learnable("doc_id")).join(labels, "doc_id").select("quality", "_score").toPandas()
    rank, good = found._score.rank(), found.quality == 1
    assert (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum()) > 0.95
    rows = plain([(1, None), (2, ""), (3, "a " * 50_000), (3, "a " * 50_000)])
    got = [r["_score"] for r in quality.score(docs(spark, rows), weights).orderBy("doc_id").collect()]
    assert got[0] == got[1] and got[2] == got[3] and all(0 <= s <= 1 for s in got)
    none = quality.fit(quality.labelled_rows(given, labels.limit(0)))
    assert quality.score(docs(spark, rows), none).first()["_score"] == 0.5


# --- pages


def test_main_text(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    forest = html_extract.fit(given, train_pages=60, trees=20)
    got = {r["page_id"]: r["_text"] for r in html_extract.extract(given, forest).collect()}
    for row in given.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        import html

        blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))]
        assert got[row["page_id"]] == "\n\n".join(b for b in blocks if b)
    rows = [(1, None), (2, ""), (3, "plain text"), (4, "<p>a<p>b"), (5, "<div" * 3), (6, "<article>" + "<p>x &lt; y &amp z</p>" * 3), (6, "</p></div><!-- "), (7, "<div>" * 3000 + "deep")]
    odd = {r["page_id"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, html string"), forest).collect()}
    assert odd == {1, 2, 3, 4, 5, 6, 7}


def test_main_text_without_named_articles(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html").collect()
    plain_pages = [(r["page_id"], r["html"].replace("<article>", "<div>").replace("</article>", "</div>")) for r in rows]
    given = spark.createDataFrame(plain_pages, "page_id long, html string")
    named = html_extract.main_texts([r["html"] for r in rows], html_extract.fit(spark.createDataFrame(rows), trees=20))
    got = html_extract.main_texts([source for _, source in plain_pages], html_extract.fit(given))
    kept = [set(a.split()) & set(b.split()) for a, b in zip(got, named)]
    assert all(named) and all(kept) and sum(a == b for a, b in zip(got, named)) >= 0.9 * len(rows)
    nothing = html_extract.fit(given.limit(0))
    assert html_extract.main_texts(["<div>a<p>b</p></div><script>c</script>"], nothing) == ["a\n\nb"]


def test_markup_is_read():
    def text(source):
        page = html_extract.parse(source)
        gone = html_extract.hidden(page)
        return html_extract.text_of(page, [not g for g in gone])

    assert text("<p>a <b>b</b>c<br>d<p>e&amp;f &lt;g&gt; &#233;") == "a bc d\n\ne&f <g> é"
    assert text("<script>if (a<b) '</p>'</script>x<style>p{}</style><!-- no --><div title='a>b'>y</div>z") == "x\n\ny\n\nz"
    assert text("<table><tr><td>1<td>2<tr><td>3</table>") == "1 2\n\n3"
    assert text("<ul><li>a<li>b</ul>c<textarea>d</textarea><select><option>e</select>") == "a\n\nb\n\nc"


def test_shown_text_is_left_to_the_trees(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html")
    forest = html_extract.fit(given, train_pages=60)
    words = "the words of a long paragraph in the article, and then some more of them. " * 4
    shown = "<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> holds</p><xmp><b>&lt;</xmp>"
    shown += "".join(f"<{tag}><p>kept {tag} {words}</p></{tag}>" for tag in ("noscript", "object", "noembed", "noframes"))
    page = f"<html><body><nav><ul><li><a href='/a'>menu</a></li></ul></nav><noscript>Please enable scripts.</noscript><article><h1>Head</h1><p>{words}</p>{shown}<p>{words}</p></article></body></html>"
    text = html_extract.main_texts([page], forest)[0]
    assert "where x=2 holds" in text and "<b>&lt;" in text and "tex\n" not in text and "menu" not in text
    assert all(f"kept {tag} the words" in text for tag in ("noscript", "object", "noembed", "noframes"))
    assert "enable scripts" not in text


def test_decoding_keeps_ancestors():
    page = html_extract.parse("<div><p>a</p><nav><p>b</p></nav></div>")
    rows, _ = html_extract.features(page)
    odds = {"div": -1.0, "p": 3.0, "nav": -5.0}
    kept = html_extract.decode(page, rows, np.array([odds[page.tag[k]] for k in rows]))
    # the run of text in a paragraph goes with it
    assert [page.tag[k] for k in range(1, len(kept)) if kept[k]] == ["div", "p", html_extract.RUN]
    assert all(kept[page.parent[k]] for k in range(1, len(kept)) if kept[k])


# --- archives


def test_archives(spark, tmp_path):
    rows = [(1, "http://a/ü\r\nX: y", "<p>é</p>" * 900), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>" * 900), (None, "u", "same"), (5, "u", "same"), (5, "u", "same"), (6, "u", "\r\n\r\nWARC/1.0\r\n\r\n0\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("row", F.lit(3)).repartition(3)
    got = warc.round_trip(pages, segment_bytes=700, records_per_file=3).collect()
    assert len(got) == len(rows) and all(r["problem"] is None for r in got)
    digest = lambda text: warc.payload_digest((text or "").encode())
    seen = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str)
    long_, same = "<p>é</p>" * 900, "same"
    want = [
        (1, len(long_.encode()), digest(long_), "revisit", 4),
        (2, 0, digest(""), "revisit", 3),
        (3, 0, digest(""), "response", None),
        (4, len(long_.encode()), digest(long_), "response", None),
        (None, 4, digest(same), "revisit", 5),
        (5, 4, digest(same), "revisit", 5),
        (5, 4, digest(same), "response", None),
        (6, len(rows[-1][2]), digest(rows[-1][2]), "response", None),
    ]
    assert seen == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_broken_archives_are_named(spark, tmp_path):
    good = warc.records_of("1:1", "u", "response", None, b"x" * 3000, 500)
    cases = {"gap": good[:2] + good[3:], "short": good[:-1], "whole": good}
    for name, parts in cases.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.warc").write_bytes(b"".join(p + b"\r\n\r\n" for p in reversed(parts)))
    found = {name: warc.read(spark, str(tmp_path / name)).first() for name in cases}
    assert found["gap"]["problem"] == "segments missing" and found["short"]["problem"] == "total length differs"
    assert found["whole"]["problem"] is None and bytes(found["whole"]["payload"]) == b"x" * 3000


def test_chunks():
    for size in (0, 1, 4096, 10_000):
        assert warc.unchunked(warc.chunked(b"z" * size, 64)) == b"z" * size
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


def test_numbers_follow_the_order(spark):
    rows = spark.createDataFrame([(k * 7919 % 1000,) for k in range(1000)] + [(None,)], "a int")
    got = {r["a"]: r["n"] for r in numbered(rows, [F.col("a").asc_nulls_last()], "n", 7).collect()}
    assert got == {None: 1000} | {k: k for k in range(1000)}
