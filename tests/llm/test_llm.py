"""Each operator against a plain version or an exact round trip, and on edge rows."""

import collections
import hashlib
import pickle
import random
import re
import time
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import xxhash
from plain import SF_DIR, by_id, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from oracle import compare
from relaybook.llm import chat, decontaminate, licenses, mixing, quality, queries, shards, simhash, tokens
from relaybook.llm import toxicity, urls
from relaybook.llm.common import table
from relaybook.llm.fmindex import FMIndex


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), queries.SQL[name], SF_DIR) > 0


@pytest.mark.parametrize("name", ["op1_mix", "op3_url_filter", "op8_license_scan", "op9_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [part for part in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop") if part in plan]


def test_registered():
    found = entry_points.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {re.match(r"op\d+_", n)[0] for n in found if n.startswith("op")}
    assert "pipeline" in found


# Quality ----------------------------------------------------------------------------------------


def test_quality_counts(spark):
    text = "a b c d e f g h\nx #\na b c d e f g h\n \na b c d e f g h"
    found = quality.judge(spark.createDataFrame([(text,)], "text string")).first()
    assert (found.n_words, found.n_symbols, found.n_dup_lines, found.n_lines) == (26, 1, 2, 4)
    assert found.n_repeat_words == 24 and found.word_chars == 26 and found.base_failed


def test_quality_repeats_against_plain(spark):
    pick = random.Random(5)
    texts = [" ".join(pick.choice("abc") for _ in range(n)) for n in (7, 8, 9, 40, 300, 2000)]
    found = quality.judge(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    for row in found:
        ws = row.text.split()
        seen = collections.Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
        hit = {j for i in range(len(ws) - 7) if seen[tuple(ws[i:i + 8])] > 1 for j in range(i, i + 8)}
        assert row.n_repeat_words == len(hit)


def test_quality_edges(docs, none):
    found = quality.judge(docs).collect()
    assert len(found) == docs.count() and not any(r.kept for r in found if not (r.text or "").strip())
    assert quality.judge(none).count() == 0 and quality.keep_good(none).columns == none.columns
    assert quality.keep_good(docs, ()).columns == docs.columns


#: Ordinary paragraphs that have none of the stop words, or none that are parted by blanks.
PARAGRAPHS = {
    "ru": "Весной река выходит из берегов и заливает луга вокруг деревни. Люди переносят лодки ближе к домам, "
          "а дети смотрят, как лёд медленно плывёт мимо старой мельницы. Через несколько недель вода спадает, "
          "и на полях появляется первая зелень.",
    "pl": "Wiosną rzeka występuje z brzegów i zalewa łąki wokół wsi. Ludzie przenoszą łodzie bliżej domów, "
          "a dzieci patrzą, jak lód powoli płynie obok starego młyna. Po kilku tygodniach woda opada "
          "i na polach pojawia się pierwsza zieleń.",
    "zh": "\n".join(["春天河水漫过两岸，淹没了村庄周围的草地。", "人们把小船搬到房屋附近，孩子们看着冰块慢慢漂过旧磨坊。",
                     "几个星期以后水退了，田野里出现了第一片绿色。"][n % 3] + str(n) for n in range(24)),
    "fi": "Keväällä joki tulvii ja peittää kylän niityt vedellä. Ihmiset siirtävät veneensä lähemmäs taloja, "
          "lapset katsovat kuinka jää kulkee hitaasti vanhan myllyn ohi. Muutaman viikon kuluttua vesi laskee "
          "pelloille ilmestyy ensimmäinen vihreä.",
}


def test_paragraphs_of_other_languages_are_kept(spark):
    rows = spark.createDataFrame(list(PARAGRAPHS.items()), "lang string, text string")
    assert {r.lang: r.kept for r in quality.judge(rows, lang="lang").collect()} == dict.fromkeys(PARAGRAPHS, True)
    # Without the language, the script and the stop words decide; Finnish has none here.
    assert {r.lang for r in quality.judge(rows).filter("kept").collect()} == {"ru", "pl", "zh"}
    junk = spark.createDataFrame([("ru", "## $$ || " * 30), ("en", "zxqv bnmk wrtp " * 9)], "lang string, text string")
    assert quality.keep_good(junk, lang="lang").count() == 0
    unnamed = spark.createDataFrame([(None, PARAGRAPHS["pl"]), ("en", "brzeg rzeka łódź " * 9 + "dom")], "lang string, text string")
    assert [r.lang for r in quality.keep_good(unnamed, lang="lang").collect()] == [None]


# SimHash ----------------------------------------------------------------------------------------


def plain_fingerprint(text, width=3):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(simhash._LOWER))
    shingles = [b" ".join(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, radius):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [root(x) for x in range(len(prints))]


def test_fingerprints(docs):
    for row in simhash.fingerprints(docs.select("doc_id", "text", F.col("text").alias("t"))).collect():
        assert row.fingerprint % 2**64 == plain_fingerprint(row.t)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_sliced_distances(radius):
    pick = np.random.default_rng(radius)
    lanes = pick.integers(0, 2**64, 64, dtype=np.uint64)
    queries_ = lanes ^ np.array([sum(1 << int(b) for b in pick.choice(64, n % 9, replace=False)) for n in range(64)], np.uint64)
    found = simhash.within(queries_, np.repeat(simhash.planes(lanes.reshape(1, 64)), 64, 0), radius)
    for q, word in zip(queries_.tolist(), found.tolist(), strict=True):
        assert word == sum(1 << i for i, x in enumerate(lanes.tolist()) if (x ^ q).bit_count() <= radius)


@pytest.mark.parametrize("most", [4096, 24])
def test_classes_against_all_pairs(spark, most):
    pick = random.Random(3)
    prints = {pick.getrandbits(64) for _ in range(150)}
    for base in list(prints)[:12]:
        for _ in range(30):
            base ^= 1 << pick.randrange(64) | (1 << pick.randrange(64) if pick.random() < 0.5 else 0)
            prints.add(base)
    prints = sorted(prints)
    rows = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fingerprint long")
    labels = {r.node % 2**64: r.label % 2**64 for r in simhash.classes(simhash.all_links(rows, 3, most)).collect()}
    expected = plain_classes(prints, 3)
    groups = collections.defaultdict(set), collections.defaultdict(set)
    for at, p in enumerate(prints):
        groups[0][expected[at]].add(p)
        groups[1][labels.get(p, p)].add(p)
    assert sorted(map(sorted, groups[0].values())) == sorted(map(sorted, groups[1].values()))


def test_simhash_query(spark):
    stored = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    ids = sorted(stored)
    prints = [plain_fingerprint(stored[i]) for i in ids]
    expected = {i: ids[c] for i, c in zip(ids, plain_classes(prints, 3), strict=True)}
    found = queries.op6_simhash(spark, SF_DIR).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in found} == {
        i: (p, expected[i]) for i, p in zip(ids, prints, strict=True)}


def test_simhash_edges(docs, none):
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    assert {r.component_id for r in found if r.fingerprint == 0} == {2}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id in (2, 3, 5, 7)").collect()) == [2, 7, 7]


def test_classes_that_share_an_id_keep_one_row_each(spark):
    begin, other = (" ".join(f"{c}{n}" for n in range(400)) for c in "xy")
    rows = [(0, begin), (0, other), (1, begin), (2, other), (2, other), (0, other), (3, f"{begin} {other}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, simhash.one_of_each(docs).collect()))
    assert kept == [(0, begin), (0, other), (3, f"{begin} {other}")]


def test_rows_that_differ_in_other_columns_only(spark):
    """Which of them stays does not depend on their order."""
    rows = [(1, "some words of a text that repeats", n) for n in range(20)] + [(2, "another text", 5)]
    kept = [simhash.one_of_each(spark.createDataFrame(found, "doc_id long, text string, n int")).collect()
            for found in (rows, rows[::-1], rows[7:] + rows[:7])]
    assert all(len(found) == 2 for found in kept) and len({str(sorted(map(tuple, found))) for found in kept}) == 1


def test_null_ids_keep_one_row_of_a_class(spark):
    begin = " ".join(f"w{n}" for n in range(2000))
    texts = [f"{begin} end{n}" for n in range(20)]
    marks = {simhash.fingerprint(t.encode()) for t in texts}
    assert len(marks) > 1 and all((a ^ b).bit_count() <= simhash.RADIUS for a in marks for b in marks)
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    assert simhash.one_of_each(docs).count() == 1


# Decontamination --------------------------------------------------------------------------------


def test_fm_index_against_plain():
    pick = random.Random(9)
    text = np.array([pick.randint(1, 4) for _ in range(700)] + [2] * 90)
    index = FMIndex(text, every=5)
    phrases = [tuple(pick.randint(1, 5) for _ in range(pick.randint(1, 6))) for _ in range(200)]
    lengths = np.array([len(p) for p in phrases])
    padded = np.zeros((200, 6), np.int64)
    for row, p in zip(padded, phrases, strict=True):
        row[: len(p)] = p
    which, place = index.locate(*index.search(padded, lengths))
    expected = sorted((n, i) for n, p in enumerate(phrases) for i in range(len(text)) if tuple(text[i:i + len(p)]) == p)
    assert sorted(zip(which.tolist(), place.tolist(), strict=True)) == expected


ITEMS = [(1, "the quick brown fox jumps over the lazy dog and runs away"), (2, "Words AGAIN"), (2, "words again"),
         (None, "no id"), (3, None), (4, " . "), (10, "again and again")]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 20}, {"shard_words": 3}, {"block_windows": 2}])
def test_decontamination_edges(spark, docs, none, options):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.decontaminate(docs, items, window=10, **options).collect()
    assert len(found) == docs.count()
    one = by_id(found, 1)
    # Two windows of item 1 are in the text: words 0 to 9 and 1 to 10. Its third needs "away".
    assert [(s.first, s.last) for s in one.spans] == [(0, 10)]
    assert one["items"] == ["1"] and by_id(found, 4).n_words == 40_000
    seven = [r for r in found if r.doc_id == 7 and "same" in r.text]
    assert len(seven) == 2 and all(r["items"] == ["10", "2"] and [(s.first, s.last) for s in r.spans] == [(1, 4)] for r in seven)
    assert by_id(found, None)["items"] == [] and len(by_id(found, None).spans) == 1
    assert decontaminate.decontaminate(none, items, **options).count() == 0
    assert all(not r.spans for r in decontaminate.decontaminate(docs, items.limit(0)).collect())
    cut = decontaminate.without_benchmark(docs, items, **options)
    assert cut.columns == docs.columns and by_id([r for r in cut.collect() if r.text and "same" in r.text], 7).text == "same "


def test_phrases_are_bounded_in_memory():
    """A block of 300,000 windows takes 150 bytes a window and 120 a word, at its peak."""
    pick = random.Random(5)
    vocabulary = [f"word{n}" for n in range(20_000)]
    rows = [(str(n), " ".join(pick.choices(vocabulary, k=309)).encode()) for n in range(1000)]
    tracemalloc.start()
    phrases = decontaminate.Phrases.of(rows, 10)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(phrases.windows) == 300_000 and len(pickle.dumps(phrases)) < 30_000_000
    assert held < 300_000 * 75 + 20_000 * 120 and peak < 300_000 * 250
    plain = collections.defaultdict(set)
    for item, text in rows[:20]:
        ids = [phrases.numbers[w] for w in text.split()]
        for at in range(len(ids) - 9):
            plain[tuple(ids[at:at + 10])].add(item)
    found = {tuple(w): n for n, w in enumerate(phrases.windows.tolist())}
    assert all(items <= set(phrases.items(found[w])) for w, items in plain.items())


def test_text_column_in_another_case(spark):
    docs = spark.createDataFrame([(1, "x words again y")], "doc_id long, Text string")
    items = spark.createDataFrame([(1, "words again")], "item_id long, text string")
    cut = decontaminate.without_benchmark(docs, items)
    assert cut.columns == ["doc_id", "Text"] and [r.Text for r in cut.collect()] == ["x  y"]


# Mixing -----------------------------------------------------------------------------------------


def test_targets(spark):
    sizes = [("=a", "a", 10), ("=b", "b", 1000), ("=c", "c", 500), ("-", None, 490), ("=d", "d", 0)]
    rows = mixing.targets(spark.createDataFrame(sizes, "stream string, source string, source_size long")).collect()
    found = {r.stream: r.target for r in rows}
    assert found["=a"] == 20 and found["=d"] == 0 and sum(found.values()) == pytest.approx(3000)
    assert found["-"] == 980 and found["=c"] == 1000 and found["=b"] == pytest.approx(1000)


@pytest.mark.parametrize("knots", mixing.SCHEDULES)
def test_due_inverts_the_integral(spark, knots):
    rows = spark.range(0, 1001).select((F.col("id") / 1000).alias("share"))
    times, weights = zip(*knots, strict=True)

    def area(t):
        grid = np.linspace(0, t, 20001)
        return np.trapezoid(np.interp(grid, times, weights), grid)

    for row in rows.select("share", mixing.due(F.col("share"), knots).alias("t")).collect()[::50]:
        assert area(row.t) / area(1) == pytest.approx(row.share, abs=1e-6)


def test_mix_edges(docs, none):
    found = mixing.mix(docs).collect()
    assert len(found) == docs.count() and all(0 <= r.taken <= 2 * r.size for r in found)
    assert all(r.taken == 0 for r in found if r.size == 0)
    assert all(len(r.positions) == r.copies and all(0 <= p <= 1 for p in r.positions) for r in found)
    assert mixing.mix(none).count() == 0
    made = mixing.mixed_documents(docs)
    assert made.columns == docs.columns and made.count() == sum(r.copies for r in found)


def test_mix_is_near_its_targets_and_in_order(spark):
    found = mixing.mix(table(spark, SF_DIR, "documents")).collect()
    by = collections.defaultdict(list)
    for row in found:
        by[row.source].append(row)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows) / 2 + 1


# Shards -----------------------------------------------------------------------------------------


def test_shards(spark):
    stored = {r.doc_id: r.text.encode() for r in table(spark, SF_DIR, "documents").collect()}
    rows = queries.op5_shard(spark, SF_DIR).collect()
    by = collections.defaultdict(list)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(stored[r.doc_id]) + 16, zlib.crc32(stored[r.doc_id]))
        assert r.next_shard in (r.shard, queries.SHARDS) and r.law == "bytes"
        by[r.shard].append(r)
    loads = [sum(r.size for r in v) for v in by.values()]
    assert len(by) == queries.SHARDS and max(loads) - min(loads) <= max(r.size for r in rows)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())


def test_slot_maps(spark, folder, docs, none):
    store = shards.SlotMap(spark, folder)
    first = shards.shard(docs, 3, slot_map=store)
    again = shards.shard(docs, 3, slot_map=store, version=1)
    key = ("doc_id", "text", "shard")
    assert sorted(map(str, first.select(*key).collect())) == sorted(map(str, again.select(*key).collect()))
    assert first.count() == docs.count() and shards.shard(none, 3).count() == 0
    one, two = store.read(1), store.read(2)
    assert {b for a, b in zip(one, two, strict=True) if a != b} <= {3}
    pick = random.Random(1)
    sizes = [pick.randint(0, 99) for _ in range(500)]
    even = shards.spread(sizes, 7)
    drifted = [s * (3 if even[n] == 2 else 1) for n, s in enumerate(sizes)]
    mended = shards.rebalanced(even, drifted, 7)
    loads = [sum(s for s, at in zip(drifted, mended, strict=True) if at == n) for n in range(7)]
    assert max(loads) <= sum(drifted) / 7 * 1.02 + 99
    more = shards.grown(even, sizes, 7)
    assert sum(s for s, at in zip(sizes, more, strict=True) if at == 7) == pytest.approx(sum(sizes) / 8, rel=0.05)


def test_drifted_bytes_write_the_next_version(spark, folder):
    store = shards.SlotMap(spark, folder)
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    first = shards.shard(docs, 5, slot_map=store).select("doc_id", "shard", "virtual_slot")
    assert store.versions() == [1, 2] and shards.rebalance(docs, 5, store, 1) == 1 and store.versions() == [1, 2]
    # Documents come that the map puts into one shard; it is edited, and only slots of that shard move.
    more = spark.range(10_000, 40_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("y"), F.lit(90)).alias("text"))
    full = shards.shard(more, 5, slot_map=store, version=1, carry=["doc_id", "text"]).filter("shard = 2")
    drifted = docs.unionAll(full.select("doc_id", "text"))
    before = {r.virtual_slot: r.shard for r in shards.shard(drifted, 5, slot_map=store, version=1).collect()}
    version = shards.rebalance(drifted, 5, store, 1)
    assert version == 3 and store.versions() == [1, 2, 3] and first.count() == 6000
    placed = shards.shard(drifted, 5, slot_map=store, version=version).collect()
    loads = collections.Counter()
    for r in placed:
        loads[r.shard] += r["size"]
    assert len(placed) == drifted.count() and max(loads.values()) <= 1.02 * sum(loads.values()) / 5
    moved = {(before[r.virtual_slot], r.shard) for r in placed if r.shard != before[r.virtual_slot]}
    assert moved and {a for a, _ in moved} == {2}
    assert shards.rebalance(drifted.limit(0), 5, store, 1) == 1


# Tokens -----------------------------------------------------------------------------------------

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts(spark):
    library = Tokenizer.from_file(BPE)
    pick = random.Random(2)
    marks = ["'s", " ", "  ", "\n", "\t\n ", "a", "Été", "ß", "½3", "don't", "ǅ", "\x85", "\xa0", "\xad", "\x1c", "東",
             "😀", "<|endoftext|>", "<|", "__", "...", "hello", "World", "\u200b", "Ωμ", "́"]
    texts = ["".join(pick.choice(marks) for _ in range(pick.randint(0, 30))) for _ in range(1500)] + [None, "x" * 5000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for row in tokens.count_tokens(rows, BPE).collect():
        whole = texts[row.doc_id] or ""
        assert row.n_tokens == len(library.encode(whole, add_special_tokens=False).ids), whole
        assert row.n_bytes == len(whole.encode()) and row.over_limit == (row.n_tokens > 512)


def test_only_stretches_with_other_characters_go_to_the_library():
    """Of a text with curly quotes, dashes and a few words of another script, the rest is counted by the shortcut."""
    library = Tokenizer.from_file(BPE)
    counter = tokens.Counter(BPE)
    text = "It is “quoted” — and so on, in plain words that go on and on.  Two blanks,\n\n東京 lines\u3000and\ttabs. " * 40
    sent = []

    class Watched:
        def encode(self, part, **options):
            sent.append(part)
            return library.encode(part, **options)

    counter.library = Watched()
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert sum(map(len, sent)) < len(text) / 20


def test_token_edges(docs, none, spark):
    assert tokens.count_tokens(docs, BPE).count() == docs.count() and tokens.count_tokens(none, BPE).count() == 0
    stored = table(spark, SF_DIR, "documents").collect()
    library = Tokenizer.from_file(BPE)
    found = {r.doc_id: r.n_tokens for r in queries.op2_token_counts(spark, SF_DIR).collect()}
    assert found == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in stored}


# URLs -------------------------------------------------------------------------------------------


def test_urls(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("allow", "example.org", "/es/"),
             ("block", "a.example.org", ""), ("block", "", "/x"), ("block", None, "/"), ("allow", "net", "/p")]
    cases = {
        "http://Example.ORG/es/1?x#y": ("example.org", "/es/1", "example.org/es/", "block"),
        "http://b.example.org/e": ("b.example.org", "/e", "org/", "allow"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "http://a.example.org/es": ("a.example.org", "/es", "a.example.org", "block"),
        "x://y://z.net/p": ("y:", "//z.net/p", None, "allow"), "http://org": ("org", "", None, "allow"),
        "https://q.net/pp#": ("q.net", "/pp", "net/p", "allow"), "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://org:80/": ("org:80", "/", None, "allow"),
    }
    rows = spark.createDataFrame([(i % 3, u, "clash") for i, u in enumerate(cases)] * 2, "page_id int, url string, rule string")
    found = urls.judge_urls(rows, urls.rule_table(spark, rules)).collect()
    assert len(found) == 2 * len(cases) and {r.url: (r.host, r.path, r.rule, r.verdict) for r in found} == cases
    assert urls.judge_urls(rows.filter("false"), urls.rule_table(spark, rules)).count() == 0
    assert {r.verdict for r in urls.judge_urls(rows, urls.rule_table(spark, []), otherwise="block").collect()} == {"block"}


def test_ten_thousand_rules(spark):
    """Many path lengths cost rows of a join and no longer plan; a long url is read whole."""
    lengths = [("block", f"h{n % 40}.net", "/" + "p" * (n // 40 * 2) + str(n)) for n in range(10_000)]
    rules = spark.createDataFrame([(h, p, v) for v, h, p in lengths], "host string, path string, verdict string")
    cases = {f"http://x.h{n % 40}.net/{'p' * (n // 40 * 2)}{n}/more": f"h{n % 40}.net/{'p' * (n // 40 * 2)}{n}" for n in range(0, 10_000, 997)}
    cases |= {"http://h1.net/q": None, "http://h1.net/" + "z" * 200_000: None, "http://" + "a." * 60 + "h2.net/2": "h2.net/2"}
    pages = spark.createDataFrame([(u,) for u in cases], "url string")
    began = time.monotonic()
    judged = urls.judge_urls(pages, rules)
    judged._jdf.queryExecution().executedPlan()
    assert time.monotonic() - began < 10
    assert {r.url: r.rule for r in judged.collect()} == cases


# Chat -------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    pick = random.Random(4)
    marks = ["\\", "<", ">", "</turn>", "<+>", "<turn user>", "a", "\n", "é", "😀", "$1", "### Assistant:"]
    rows, expected = [], collections.defaultdict(list)
    for conv in range(60):
        for turn in range(pick.randint(1, 9) if conv else 700):
            role = pick.choice(["user", "assistant", "+", "/turn", "", "<x>", None])
            text = "".join(pick.choice(marks) for _ in range(pick.randint(0, 12)))
            rows.append((conv, turn, role, text or None))
            expected[conv].append((role or "", text))
    rows.append((-1, 0, "assistant", "<" + "\\x" * 200_000))
    expected[-1].append(rows[-1][2:])
    pick.shuffle(rows)
    chats = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    back = chats.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"),
                        chat.learnt_texts(F.col("formatted"), F.col("loss_mask")).alias("l"))
    for row in back.collect():
        assert [tuple(t) for t in row.t] == expected[row.conv_id]
        assert row.l == [text for role, text in expected[row.conv_id] if role == "assistant"]
    added = chat.digests(chats).filter("conv_id = -1").first()
    assert added.loss_sha256 == hashlib.sha256(rows[0][3].encode() if rows[0][0] == -1 else expected[-1][0][1].encode()).hexdigest()


def test_chat_edges(spark):
    schema = "conv_id long, turn int, role string, text string, formatted string"
    rows = spark.createDataFrame([(None, None, None, None, "x"), (1, 2, "user", "b", "x"), (1, 2, "user", "a", "x"),
                                  (1, 2, "user", "a", "x"), (1, None, "user", "z", "x")], schema)
    found = {r.conv_id: r.formatted for r in chat.format_chats(rows).collect()}
    assert found == {None: "<turn ></turn>", 1: "<turn user>z<+>a<+>a<+>b</turn>"}
    assert chat.format_chats(rows.filter("false")).count() == 0


def test_ties_are_in_the_order_of_the_texts(spark, folder):
    """A backslash that escapes must not decide: ``<`` is before ``A``. Held against the query's own SQL."""
    rows = [(1, 0, "user", "A"), (1, 0, "user", "<"), (1, 0, "user", "\\"), (1, 0, "<", "x"), (1, 0, "A", "x"), (2, 0, "assistant", "]"),
            (2, 0, "assistant", ">")]
    made = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made.coalesce(1).write.parquet(f"{folder}/parts")
    for part in Path(f"{folder}/parts").glob("*.parquet"):
        part.rename(f"{folder}/conversations.parquet")
    assert compare(queries.op4_chat_format(spark, folder), queries.SQL["op4_chat_format"], folder) == 3


# Toxicity ---------------------------------------------------------------------------------------


def test_toxicity_held_out():
    pick = random.Random(6)
    plain, bad = [f"word{i}" for i in range(300)], ["vile", "nasty", "rotten"]
    texts, labels = [], []
    for n in range(800):
        made = pick.choices(plain, k=pick.choice([30, 80, 300]))
        if n % 6 == 0:
            made = [pick.choice(bad) if pick.random() < 0.1 else w for w in [*made, "vile"]]
        texts.append(" ".join(made))
        labels.append(int(n % 6 == 0))
    scorer = toxicity.Scorer(*toxicity.fit(texts[:600], labels[:600]))
    right = sum((scorer.score(t) >= 0.5) == bool(y) for t, y in zip(texts[600:], labels[600:], strict=True))
    assert right >= 194


def test_swapped_terms_change_little():
    """Where one group is named in most bad texts, the penalty brings its score near the other's."""
    pick = random.Random(8)
    plain = [f"word{i}" for i in range(100)]
    texts, labels = [], []
    for n in range(600):
        bad = n % 3 == 0
        term = "women" if pick.random() < (0.8 if bad else 0.2) else "men"
        made = [*pick.choices(plain, k=25), term, *(["vile"] if bad and pick.random() < 0.7 else [])]
        texts.append(" ".join(made))
        labels.append(int(bad))
    neutral = " ".join(plain[:25])
    gaps = []
    for penalty in (0.0, 40.0):
        scorer = toxicity.Scorer(*toxicity.fit(texts, labels, penalty=penalty))
        gaps.append(abs(scorer.score(f"{neutral} women") - scorer.score(f"{neutral} men")))
    assert gaps[1] < 0.6 * gaps[0]


def test_mentions_are_neutral():
    """Where a group is named in most bad texts, mentions alone bring its terms together in other texts."""
    pick = random.Random(9)
    plain = [f"word{i}" for i in range(100)]
    texts, labels = [], []
    for n in range(600):
        bad = n % 3 == 0
        # Words that share their beginnings with a group's term, and no term itself.
        near = "immigration" if pick.random() < (0.8 if bad else 0.2) else "nativity"
        texts.append(" ".join([*pick.choices(plain, k=25), near, *(["vile"] if bad and pick.random() < 0.7 else [])]))
        labels.append(int(bad))
    neutral = [" ".join(pick.choices(plain, k=25)) for _ in range(40)]
    identity = (("immigrants", "natives"),)
    assert not any(toxicity.swaps(toxicity.words_of(t), identity) for t in texts)
    free, held = (toxicity.fit(texts, labels, penalty=p, identity=identity) for p in (0.0, 40.0))
    assert toxicity.mention_gap(neutral, held, identity) < 0.6 * toxicity.mention_gap(neutral, free, identity)
    assert toxicity.mention_change(neutral, held, identity) < toxicity.mention_change(neutral, free, identity)


def test_mentions_against_plain():
    texts = [toxicity.words_of(t) for t in ("a b b", "", "c women")]
    weights = np.random.default_rng(1).standard_normal(toxicity.FEATURES)
    identity = (("women", "men"), ("x", "y", "z"))
    made = toxicity.Mentions(texts, identity)
    rows = toxicity.Rows(texts, {})
    expected = [texts[i] + collections.Counter([term]) for i, group in ((0, 0), (1, 1), (2, 0)) for term in identity[group]]
    got = made.product(rows.product(weights), weights)
    # The empty text has a mean over one word, so its mention weighs half.
    whole = toxicity.Rows(expected, {}).product(weights)
    assert got[:2] == pytest.approx(whole[:2]) and got[5:] == pytest.approx(whole[5:]) and got[2:5] == pytest.approx(whole[2:5] / 2)
    slope = np.random.default_rng(2).standard_normal(len(got))
    step, at = 1e-4, toxicity.features("men")[0]
    moved = weights.copy()
    moved[at] += step
    numeric = (slope * (made.product(rows.product(weights), moved) - got)).sum() / step
    assert made.gradient(slope)[at] == pytest.approx(numeric, rel=1e-6)


def test_the_query_is_fitted_with_pairs(spark):
    """On the query's own tables every fitted text has its mentions, and the penalty moves the weights."""
    sf_dir = "/root/testdata/sf0.01"
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = toxicity.fitted_rows(documents, labels)
    assert len(toxicity.Mentions([toxicity.words_of(t) for *_, t in rows]).origin) >= 2 * len(rows) > 0
    free, held = (toxicity.fit([t for *_, t in rows], [y for _, y, _ in rows], penalty=p) for p in (0.0, 4.0))
    assert any(free[0].get(f) != w for f, w in held[0].items())
    marked = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    found = queries.op7_toxicity(spark, sf_dir).filter("held_out").collect()
    scorer = toxicity.Scorer(*held)
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    assert all(r.score == pytest.approx(scorer.score(texts[r.doc_id])) for r in found)
    right = [r.predicted == marked[r.doc_id] for r in found if r.doc_id in marked]
    assert len(right) > 40 and sum(right) / len(right) >= 0.97


def test_fitted_texts_are_bounded(spark):
    docs = spark.createDataFrame([(n, "x" * (10 if n % 2 else 5000)) for n in range(40)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    rows = toxicity.fitted_rows(docs, labels, chars=6000)
    assert 0 < sum(len(t) for *_, t in rows) <= 6000 and {i % 2 for i, *_ in rows} == {0, 1}
    assert toxicity.fitted_rows(docs, labels.limit(0)) == []


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (7, 1), (8, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    found = toxicity.score_toxicity(docs, model).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score_toxicity(none, model).count() == 0
    empty = toxicity.train(docs, labels.filter("false"))
    assert {r.score for r in toxicity.score_toxicity(docs, empty).collect()} == {0.5}


def test_toxicity_query(spark):
    found = queries.op7_toxicity(spark, SF_DIR)
    assert found.count() == table(spark, SF_DIR, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.collect())


# Licences ---------------------------------------------------------------------------------------


def test_licenses(spark):
    long_text = "some words of a story that go on. " * 3000
    mit, apache = (t for _, t in queries.LICENSE_TEMPLATES[1::-1])
    rows = [
        ("r/LICENSE", f"{mit}\n{long_text}"), ("r/a/b/x.txt", "nothing"), ("r/a/COPYING.md", apache),
        ("r/a/own.txt", f"intro\n{long_text}\nreleased under the mit license!\nmore"), ("other/x", ""), ("other/y", None),
        (None, mit), ("x", "under the license of this work"), ("r/c", long_text), ("r/c", long_text),
    ]
    files = spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit("clash"))
    templates = spark.createDataFrame(queries.LICENSE_TEMPLATES, "license string, text string")
    found = licenses.scan_licenses(files, templates).collect()
    assert len(found) == len(rows)
    got = collections.Counter((r.path, r.header_license, r.inherited_license, r.inherited_from, r.license) for r in found)
    assert got == collections.Counter({
        ("r/LICENSE", "MIT", "MIT", "r", "MIT"): 1, ("r/a/b/x.txt", None, "Apache-2.0", "r/a", "Apache-2.0"): 1,
        ("r/a/COPYING.md", "Apache-2.0", "Apache-2.0", "r/a", "Apache-2.0"): 1,
        ("r/a/own.txt", "MIT", "Apache-2.0", "r/a", "MIT"): 1, ("other/x", None, None, None, None): 1,
        ("other/y", None, None, None, None): 1, (None, "MIT", None, None, "MIT"): 1, ("x", None, None, None, None): 1,
        ("r/c", None, "MIT", "r", "MIT"): 2,
    })
    assert licenses.scan_licenses(files.filter("false"), templates).count() == 0
    assert all(r.license is None for r in licenses.scan_licenses(files, templates.filter("false")).collect())


@pytest.mark.parametrize("times", [1, 30])
def test_common_words_cost_a_header_little(spark, times):
    """Frequencies are those of the files: the score is that of true TF-IDF and does not fall as files grow in number."""
    header = "It is released under the MIT License."
    rows = [(f"d/{n}", f"it is a story {n} that is told") for n in range(100 * times)]
    rows += [(f"h/{n}", f"{header} it goes on {n}") for n in range(2 * times)]
    files = spark.createDataFrame(rows, "path string, text string")
    templates = spark.createDataFrame(queries.LICENSE_TEMPLATES[:2], "license string, text string")
    found = {r.path: r for r in licenses.scan_licenses(files, templates).collect()}
    df = collections.Counter(t for _, text in rows for t in set(re.findall(r"[a-z0-9]+", text.lower())))
    idf = {t: np.log((len(rows) + 1) / (n + 1)) + 1 for t, n in df.items()}
    common, rare = (sum(idf[t] ** 2 for t in ts.split()) for ts in ("it is", "released under the mit license"))
    assert found["h/0"].header_license == "MIT" and found["h/0"].header_score > 0.9
    assert found["h/0"].header_score >= round(float(np.sqrt(rare / (rare + common))), 9) - 1e-8
    assert found["d/0"].license is None


def test_headers_of_several_lines_and_within_lines(spark):
    notices = {name: text for name, text in queries.LICENSE_TEMPLATES if "\n" in text}
    apache, mit, gpl = (notices[name] for name in ("Apache-2.0", "MIT", "GPL-3.0"))
    commented = "\n".join(f" * {line}" for line in ["Copyright 2020 Example Corp", "", *apache.split("\n")])
    cases = {
        "a.c": (f"/*\n{commented}\n */\nint main() {{ return 0; }}\n" * 2, "Apache-2.0"),
        "b.py": ("#!/bin/python\n# " + " ".join(apache.split()) + "\nimport os", "Apache-2.0"),
        "c.js": ("// " + gpl.replace("\n", "\n// ") + "\n" + "let a = 1;\n" * 50, "GPL-3.0"),
        "LICENSE": (f"The MIT License\n\nCopyright (c) 2020 A. Person\n\n{mit}\n", "MIT"),
        "d.go": ("package d\n" + "\n".join(f"// {w}" for w in mit.split(" ")) + "\nfunc f() {}", "MIT"),
        "e.h": ("// Copyright 2020 Example Corp, all rights reserved.\nint e;", "LicenseRef-all-rights-reserved"),
        "f.txt": ("This file is licensed under the\nApache License, Version\n2.0. Read on.", "Apache-2.0"),
        "g.txt": ("The software is provided to any person under the terms of use.\nSee the rights of the person.", None),
    }
    rows = [(f"{name}/{name}", text) for name, (text, _) in cases.items()]
    rows += [(f"plain/{n}.txt", f"the story of a person {n} who is not in the law or in any other") for n in range(60)]
    files = spark.createDataFrame(rows, "path string, text string")
    templates = spark.createDataFrame(queries.LICENSE_TEMPLATES, "license string, text string")
    found = {r.path: r.header_license for r in licenses.scan_licenses(files, templates).collect()}
    assert {n: found[f"{n}/{n}"] for n in cases} == {n: name for n, (_, name) in cases.items()}
    assert not any(name for path, name in found.items() if path.startswith("plain/"))


@pytest.mark.parametrize("name", ["MIT", "Apache-2.0", "GPL-3.0"])
def test_a_notice_scores_alike_wherever_it_stands(spark, name):
    notice = max((t for n, t in queries.LICENSE_TEMPLATES if n == name), key=len)
    before = [" ".join(f"story{i}" for i in range(n)) for n in (0, 1, 2, 3, 5, 8, 31, 70)]
    rows = [(f"d{n}/f", f"{words_} {' '.join(notice.split())} it goes on and on") for n, words_ in enumerate(before)]
    files = spark.createDataFrame(rows, "path string, text string")
    templates = spark.createDataFrame(queries.LICENSE_TEMPLATES, "license string, text string")
    found = licenses.scan_licenses(files, templates).collect()
    assert {r.header_license for r in found} == {name} and {r.header_score for r in found} == {1.0}


def test_inheritance_of_the_query_against_plain(spark):
    """The whole query over sf0.01: directories are walked by plain Python from the headers that it found."""
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.path: r.text for r in queries.document_files(table(spark, sf_dir, "documents")).collect()}
    rows = {r.path: r for r in queries.op8_license_scan(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    best = {}
    for path, r in rows.items():
        if r.header_license and re.match(licenses.LICENSE_FILE, path.rpartition("/")[2]):
            folder = path.rpartition("/")[0]
            best[folder] = min(best.get(folder, (0, "~")), (-r.header_score, r.header_license))
    for path, r in rows.items():
        parts = path.split("/")[:-1]
        above = next((f for f in ("/".join(parts[:n]) for n in range(len(parts), -1, -1)) if f in best), None)
        expected = best[above][1] if above is not None else None
        assert (r.inherited_license, r.inherited_from, r.license) == (expected, above, r.header_license or expected)
    assert sum(r.inherited_license is not None for r in rows.values()) > 0


def test_license_query(spark):
    stored = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    for row in queries.op8_license_scan(spark, SF_DIR).collect():
        held = [name for name, text in queries.LICENSE_TEMPLATES if text in stored[row.doc_id]]
        assert row.header_license in (held or [None])


# Pipeline ---------------------------------------------------------------------------------------


def test_pipeline_against_plain(spark):
    """Every stage on what its predecessor kept, by plain Python up to the mix."""
    docs = table(spark, SF_DIR, "documents")
    good = {r.doc_id for r in quality.judge(docs).filter("kept").collect()}
    kept = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    ids = sorted(kept)
    root = plain_classes([plain_fingerprint(kept[i]) for i in ids], 3)
    kept = {i: kept[i] for n, i in enumerate(ids) if root[n] == n}
    items = [words(r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    windows = {tuple(ws[i:i + 10]) for ws in items for i in range(max(1, len(ws) - 9)) if ws}
    made = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        made = stage(spark, made, SF_DIR)
        assert made.columns == docs.columns
    found = {r.doc_id: r.text for r in made.collect()}
    assert found.keys() == kept.keys()
    for i, text in found.items():
        ws = words(text)
        dirty = any(tuple(words(kept[i])[j:j + 10]) in windows for j in range(len(words(kept[i])) - 9))
        assert (text == kept[i]) != dirty
        assert not any(tuple(ws[j:j + 10]) in windows for j in range(len(ws) - 9))
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} <= found.keys() and len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert max(collections.Counter(r.doc_id for r in rows).values()) <= 2


def test_pipeline_edges(spark, docs, none):
    for rows in (docs, none):
        rows = rows.select("*", F.lit("en").alias("lang"), F.lit(1).alias("n_chars"))
        whole = rows
        for _, stage in corpus_pipeline.STAGES[:4]:
            rows = stage(spark, rows, SF_DIR)
            assert rows.columns == whole.columns
        # Few of these texts pass the rules, so the other stages meet all of them too.
        rows = whole
        for _, stage in corpus_pipeline.STAGES[1:4]:
            rows = stage(spark, rows, SF_DIR)
        assert corpus_pipeline.STAGES[4][1](spark, rows, SF_DIR).count() == rows.count()
