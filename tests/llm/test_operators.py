"""The training-data operators on a small table of edge cases, against brute force."""

import collections
import hashlib
import itertools
import math
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeforge.llm import exact, minhash, mixing, piece_codec, quality, queries, rules, store, substring, urls, warc, wavelet

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"w{i}" for i in range(60))
EDGE = [
    (1, "One  two\tthree one two three four", "en", "src0"),
    (2, None, "en", "src1"),
    (3, "", None, None),
    (4, " \n\t ", "de", "src1"),
    (5, PASSAGE, "en", "src0"),
    (6, PASSAGE + " x", "en", "src0"),
    (7, "lead in " + PASSAGE + " and out " + PASSAGE, "en", "src0"),
    (8, PASSAGE, "fr", "src2"),
    (9, PASSAGE.upper(), "fr", "src2"),
    (10, "é漢字😀 ▁x  \x00y <|endoftext|> <s>", "es", "src3"),
    (11, " ".join(f"L{i % 900}" for i in range(40_000)), "en", "src0"),
    (12, "one", "en", "src5"),
    (13, "one", "en", "src5"),
    (14, "line a\nline a\n\nline a b\n#|", "en", "src5"),
    (None, PASSAGE, "en", "src0"),
]


@pytest.fixture(scope="module")
def docs(spark):
    queries.ship(spark)
    rows = [(*r, None if r[1] is None else len(r[1]), 0.5, "x", True) for r in EDGE]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, host string, kept boolean")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def words(text):
    return WORD.findall(text or "")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_pieces_equal_the_library(docs, empty):
    import sentencepiece

    path = queries.tokenizer_path(queries.PIECE_MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = by_id(piece_codec.decode(piece_codec.encode(docs, path), path))
    assert len(got) == len(EDGE)
    for doc_id, text, *_ in EDGE:
        ids = library.encode(text or "")
        assert got[doc_id]["ids"] == ids and got[doc_id]["decoded"] == library.decode(ids)
    assert piece_codec.encode(empty, path).count() == 0


def test_pieces_of_random_texts():
    import sentencepiece

    path = queries.tokenizer_path(queries.PIECE_MODEL)
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.codec(path)
    rng = np.random.default_rng(1)
    for alphabet in ("ab e\nth▁é漢 ", "thequickbrown,. ", "".join(map(chr, range(0x20, 0x250)))):
        for _ in range(300):
            text = "".join(rng.choice(list(alphabet), rng.integers(1, 60)))
            assert own.encode(text).tolist() == library.encode(text)
            assert own.decode(library.encode(text)) == library.decode(library.encode(text))
    long = "abcde" * 3000  # longer than a batch's segments
    assert own.encode(long).tolist() == library.encode(long)


def test_near_groups(spark, docs, empty):
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(80)]
    family = [(100 + i, " ".join(w if rng.random() > 0.004 * i else f"m{i}_{j}" for j, w in enumerate(base)), "en", "src0") for i in range(40)]
    rows = EDGE + family
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    low = -(1 << 63)
    sets = {}
    for i, text, *_ in rows:
        w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
        sets[low if i is None else i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    for r in minhash.near_groups(table).collect():
        i = low if r["doc_id"] is None else r["doc_id"]
        want = top(i)
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), None if want == low else want, want == i)
    assert minhash.near_groups(empty).count() == 0


def test_parity_maps_bound_the_overlap(spark):
    rng = np.random.default_rng(12)
    rows, sizes = [], []
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) > rng.choice([0.0, 0.02, 0.1, 0.5])], rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 2))).astype(np.uint64))))
        if len(b):
            both = len(np.intersect1d(a, b))
            rows.append((len(rows), len(a), len(b), minhash.parity_map(a).tolist(), minhash.parity_map(b).tolist()))
            sizes.append((both, len(a) + len(b) - both))
    df = spark.createDataFrame(rows, "i int, n bigint, n_y bigint, map array<bigint>, map_y array<bigint>")
    passed = {r["i"] for r in df.where(minhash.may_reach(80)).collect()}
    linked = {i for i, (both, all_) in enumerate(sizes) if 100 * both >= 80 * all_}
    far = {i for i, (both, all_) in enumerate(sizes) if 100 * both < 60 * all_}
    assert linked <= passed and len(linked) > 50 and len(passed & far) < 0.2 * len(far)


def test_last_pass_tests_few_pairs_that_are_no_links(spark, monkeypatch):
    """Documents that differ from one text in two words each: most pairs are no
    links, and few of those are read."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(300):
        w = list(base)
        for at in rng.choice(60, 2, replace=False):
            w[at] = f"c{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    tried, test = [], minhash.confirm
    monkeypatch.setattr(minhash, "confirm", lambda pairs, *rest: tried.append(pairs.count()) or test(pairs, *rest))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_groups(table).collect()}
    sets = [{tuple(t.split()[k:k + 3]) for k in range(58)} for _, t in rows]
    parent = list(range(300))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = 0
    for a, b in itertools.combinations(range(300), 2):
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            links += 1
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    assert got == {i: top(i) for i in range(300)}
    assert tried[-1] < 300 and links > 5


def test_near_groups_of_repeated_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(80)) for c in "pqr")
    near = lambda t: t + " more"
    rows = [(3, one), (5, two), (7, near(one)), (7, near(two)), (7, near(one)), (None, three), (None, "alone stands this"), (9, near(three)), (None, None), (7, "")]
    got = minhash.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "component_id", "kept", "n_shingles").collect()
    want = [(3, 3, True, 78), (5, 5, True, 78), (7, 3, False, 79), (7, 3, False, 79), (7, 5, False, 79), (7, 7, True, 0), (9, None, False, 79), (None, None, True, 0), (None, None, True, 1), (None, None, True, 78)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    # of two documents of one id in a component, one is kept
    pair = minhash.near_groups(spark.createDataFrame([(1, one), (1, near(one)), (1, one.upper())], "doc_id bigint, text string")).collect()
    assert [r["component_id"] for r in pair] == [1, 1, 1] and sum(r["kept"] for r in pair) == 1


def test_tables_follow_the_threshold(spark):
    assert [minhash.sides(p) for p in (85, 80)] == [9, 12]
    assert all(minhash.missed(p / 100, minhash.sides(p)) <= minhash.MISS for p in range(30, 101))
    text = spark.createDataFrame([(1, "a b c d e f", "x")], "id bigint, text string, sha string")
    for percent, tables in ((85, 81), (80, 144)):
        assert minhash.keyed(minhash.signatures(text, 5, minhash.sides(percent))).select("key").distinct().count() == tables


def test_repeats(docs, empty):
    order = sorted(EDGE, key=lambda r: -(1 << 63) if r[0] is None else r[0])
    first = {}
    for i, text, *_ in order:
        w = words(text)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), i)
    got = by_id(substring.find_repeats(docs))
    assert len(got) == len(EDGE)
    for i, text, *_ in EDGE:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] != i:
                gone[k:k + 13] = [True] * 13
        r = got[i]
        assert (r["n_words"], sum(r["lengths"])) == (len(w), sum(gone))
        assert r["kept"] == " ".join(x for x, g in zip(w, gone, strict=True) if not g)
    assert substring.find_repeats(empty).count() == 0


def test_exact_groups(docs, empty):
    groups = collections.defaultdict(list)
    for i, text, *_ in EDGE:
        groups[text or ""].append(i)
    got = by_id(exact.exact_groups(docs))
    assert len(got) == len(EDGE)
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: -1 if i is None else i)
        for i in ids:
            r = got[i]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(ids), i == keep)
            assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert exact.exact_groups(empty).count() == 0


def test_long_texts_that_differ_late(spark):
    long = "y" * 30_000
    rows = [(1, long + "a"), (2, long + "b"), (3, long + "a"), (4, long)]
    got = by_id(exact.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert {i: r["keep_id"] for i, r in got.items()} == {1: 3, 2: 2, 3: 3, 4: 4}


def test_rules(docs, empty):
    got = by_id(rules.apply_rules(docs))
    for i, text, *_ in EDGE:
        w = words(text)
        count = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        again = {k + j for k in range(len(w) - 2) if count[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(again))
        assert (r["n_symbols"], r["n_dup_lines"]) == (sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)))
        failed = len(w) < 50 or 2 * len(again) > len(w)
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert rules.apply_rules(empty).count() == 0


def test_shrinking_spares_small_hosts(spark):
    rows = [(h, f) for h, n, bad in (("big", 100, 95), ("small", 2, 2), *((f"h{k}", 50, 2) for k in range(12))) for f in [True] * bad + [False] * (n - bad)]
    verdicts = {r["host"]: r for r in rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean"), max_rate=0.8).collect()}
    assert not verdicts["big"]["host_kept"] and verdicts["h1"]["host_kept"]
    assert 1 - verdicts["small"]["rate"] > 2 * (0.95 - verdicts["big"]["rate"]) > 0  # the fewer documents, the nearer to the prior


def test_budgets_go_to_siblings_first(spark):
    rows = [("a", "x", "s1", 100), ("a", "x", "s2", 1000), ("a", "y", "s3", 50), ("b", "x", "s4", 1000)]
    tokens = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id bigint, domain string, lang string, source string, n_tokens bigint")
    mix = mixing.Mix(weights={("a",): 1, ("b",): 1}, percent=50, max_epochs=1)
    leaves = mixing.leaf_budgets(tokens, mix)
    share = {r["source"]: r["share"] for r in leaves.collect()}
    # 1075 in all: 537 and 538; of the first, y has 50 and x takes its shortage; s1 has 100 and s2 takes its shortage
    assert share["s3"] == 50 and share["s1"] == 100 and share["s4"] in (537, 538) and sum(share.values()) == 1075
    taken = mixing.select(tokens, leaves, mix).groupBy("source").agg(F.sum("take_tokens").alias("n"))
    assert {r["source"]: r["n"] for r in taken.collect()} == share


def test_epochs(spark, docs, empty):
    mix = mixing.Mix(weights={("web", "en"): 50}, percent=100, max_epochs=2)
    domain = queries.domain_of_source()
    rows = mixing.mix_documents(docs, domain, mix).collect()
    assert all(0 < r["take_tokens"] <= r["n_tokens"] for r in rows) and all(r["epoch"] < 2 for r in rows)
    assert sum(r["take_tokens"] for r in rows) == sum(len(words(t)) for _, t, *_ in EDGE)
    assert mixing.mix_documents(empty, domain, mix).count() == 0


def test_urls(spark, docs):
    page_rows = [
        (1, "http://A.B.example.com/en/x?q"), (2, "https://www.example.com/en/"), (3, "http://x.net/es/1"), (4, "http://net/fr/"), (5, None), (6, "no host"),
        (7, "http://other.org/"), (8, "http://xcom/"), (9, "ftp://c.com#f"), (10, "http://example.com/en"), (11, "http://" + "a." * 300 + "com/" + "p" * 5000),
        (12, "http://.com/"), (None, "http://x.com/"), (7, "http://other.org/"),
    ]
    table = spark.createDataFrame([(*r, "v") for r in page_rows], "page_id bigint, url string, verdict string")
    rule_rows = queries.URL_RULES + [("com", "/en/x", "block"), ("com", "/en/", "allow")]
    rule_table = spark.createDataFrame(rule_rows, "host string, path string, verdict string")
    got = {(r["page_id"], r["host"], r["path"]): (r["rule"], r["verdict"]) for r in urls.judge(table, rule_table).collect()}
    want = {}
    for page_id, url in page_rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rule_rows if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[page_id, host, path] = max(fits)[2:] if fits else (None, "allow")
    assert got == want
    assert {r["verdict"] for r in urls.judge(table, rule_table.where("false")).collect()} == {"allow"}
    # a row for each row: repeated ones, and urls of one page that differ after ? or # alone
    many = table.union(table).union(spark.createDataFrame([(1, "http://A.B.example.com/en/x?other", "v"), (1, "http://A.B.example.com/en/x#f", "v")], table.schema))
    rows = collections.Counter((r["page_id"], r["host"], r["path"]) for r in urls.judge(many, rule_table).collect())
    assert sum(rows.values()) == 2 * len(page_rows) + 2 and rows[1, "a.b.example.com", "/en/x"] == 4 and rows[7, "other.org", "/"] == 4
    assert urls.judge(table.where("false"), rule_table).count() == 0


def test_wavelet_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.WORD_MODEL)
    library = Tokenizer.from_file(path)
    manifest = wavelet.write_shards(docs, store.new_dir(spark, "t"), path, end_id=1, shard_tokens=500)
    got = by_id(wavelet.read_shards(spark, manifest))
    start = 0
    for i, text, *_ in sorted(EDGE, key=lambda r: -1 if r[0] is None else r[0]):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert got[i]["ids"] == ids and (got[i]["start"], got[i]["n_tokens"]) == (start, len(ids))
        start += len(ids)
    digests = by_id(wavelet.read_shards(spark, manifest, wavelet.crc32_le))
    assert digests[3]["digest"] == zlib.crc32((1).to_bytes(4, "little"))
    assert wavelet.read_shards(spark, wavelet.write_shards(empty, store.new_dir(spark, "t"), path)).count() == 0


def test_repeated_rows(spark, docs):
    """Rows that repeat are rows of their own, with the same results."""
    twice, path = docs.union(docs), queries.tokenizer_path(queries.PIECE_MODEL)
    one, two = (collections.Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in piece_codec.decode(piece_codec.encode(d, path), path).collect()) for d in (docs, twice))
    assert two == {k: 2 * n for k, n in one.items()}
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    one, two = (collections.Counter(tuple(r[c] for c in base) for r in rules.apply_rules(d).collect()) for d in (docs, twice))
    assert two == {k: 2 * n for k, n in one.items()}
    manifest = wavelet.write_shards(twice, store.new_dir(spark, "t"), queries.tokenizer_path(queries.WORD_MODEL), end_id=1)
    read = wavelet.read_shards(spark, manifest).orderBy("start").collect()
    assert len(read) == 2 * len(EDGE) and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(read, read[1:], strict=False))
    assert collections.Counter(r["doc_id"] for r in read) == {i: 2 for i, *_ in EDGE}
    domain, mix = queries.domain_of_source(), mixing.Mix(percent=50, max_epochs=2)
    total = sum(len(words(t)) for _, t, *_ in EDGE)
    for d, n in ((docs, total), (twice, 2 * total)):
        assert mixing.mix_documents(d, domain, mix).agg(F.sum("take_tokens")).first()[0] == n * 50 // 100


def test_budgets_by_filling_step_by_step(spark):
    """Shares against a plain filling: all open children rise by weight until the
    budget is gone or the next one is full."""
    rng = np.random.default_rng(21)
    rows, want = [], {}
    for p in range(60):
        caps, weights = rng.integers(0, 40, 6).tolist(), rng.integers(0, 5, 6).tolist()
        budget = int(rng.integers(0, 150))
        rows += [(p, c, cap, w, budget) for c, (cap, w) in enumerate(zip(caps, weights, strict=True))]
        level = [Fraction(0)] * 6
        left = Fraction(min(budget, sum(c for c, w in zip(caps, weights, strict=True) if w)))
        while left:
            open_ = [c for c in range(6) if weights[c] and level[c] < caps[c]]
            step = min(left / sum(weights[c] for c in open_), *((caps[c] - level[c]) / weights[c] for c in open_))
            for c in open_:
                level[c] += step * weights[c]
            left -= step * sum(weights[c] for c in open_)
        want[p] = (level, caps, weights, budget)
    df = spark.createDataFrame(rows, "p int, c int, cap bigint, weight bigint, budget bigint")
    got = collections.defaultdict(dict)
    for r in mixing.split_budget(df, ["p"], "c").collect():
        got[r["p"]][r["c"]] = r["share"]
    for p, (level, caps, weights, budget) in want.items():
        assert all(abs(got[p][c] - level[c]) < 1 and 0 <= got[p][c] <= caps[c] for c in range(6)), (got[p], level)
        assert sum(got[p].values()) == sum(level)


def test_repeats_of_rows_that_share_an_id(spark):
    rows = [(1, PASSAGE), (1, PASSAGE + " x"), (2, PASSAGE), (2, "y " + PASSAGE), (None, "lead " + PASSAGE), (None, PASSAGE)]
    got = collections.Counter((r["doc_id"], r["n_words"], r["kept"]) for r in substring.find_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    # a null id is smaller than others; rows of one id are no repeats of each other
    assert got == {(1, 60, ""): 1, (1, 61, "x"): 1, (2, 60, ""): 1, (2, 61, "y"): 1, (None, 61, "lead " + PASSAGE): 1, (None, 60, PASSAGE): 1}
    alone = collections.Counter((r["doc_id"], r["kept"]) for r in substring.find_repeats(spark.createDataFrame(rows[:3], "doc_id bigint, text string")).collect())
    assert alone == {(1, PASSAGE): 1, (1, PASSAGE + " x"): 1, (2, ""): 1}


def test_exact_groups_of_null_and_repeated_ids(spark):
    rows = [(None, "a"), (None, "a"), (3, "a"), (None, "b"), (None, "b"), (4, "c"), (4, "c"), (4, "d"), (5, None), (6, ""), (7, "alone")]
    got = collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(None, 3, 3, False, sha("a")): 2, (3, 3, 3, True, sha("a")): 1, (None, None, 2, True, sha("b")): 2, (4, 4, 2, True, sha("c")): 2, (4, 4, 1, True, sha("d")): 1,
                   (5, 6, 2, False, sha("")): 1, (6, 6, 2, True, sha("")): 1, (7, 7, 1, True, sha("alone")): 1}


@pytest.fixture
def parts_stay(spark):
    """Small partitions aren't merged, as large ones wouldn't be."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_rows_of_one_id_are_dealt_over_tasks(spark, parts_stay):
    """No id, or one id, on most rows: several tasks write, and several groups are made."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 3 == 1, 7).alias("doc_id"), F.concat(F.lit("text of row "), F.col("id").cast("string")).alias("text"))
    manifest = wavelet.write_shards(rows, store.new_dir(spark, "t"), queries.tokenizer_path(queries.WORD_MODEL), end_id=1)
    sizes = sorted(r["n"] for r in manifest.groupBy("part").agg(F.sum("n_docs").alias("n")).collect())
    assert sum(sizes) == 20_000 and sizes[-1] < 6_000
    read = wavelet.read_shards(spark, manifest)
    starts = [(r["start"], r["n_tokens"]) for r in read.orderBy("start").collect()]
    assert all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:], strict=False)) and len(starts) == 20_000
    pages = rows.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    files = warc.write_warc(pages, store.new_dir(spark, "w"))
    sizes = sorted(r["n"] for r in files.groupBy("part").agg(F.sum("n_records").alias("n")).collect())
    assert sum(sizes) == 20_000 and sizes[-1] < 6_000
    assert substring.find_repeats(rows).agg(F.sum(F.size("starts"))).first()[0] == 0


def test_wavelet_decomposed_capitals(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path(queries.WORD_MODEL)
    library, own = Tokenizer.from_file(path), wavelet.WordTokenizer(path)
    texts = ["J\u030c", "T\u0308", "H\u0331", "W\u030a", "j\u030c", "Plain aJ\u030cb, T\u0308-x =\u0338 PLAIN plain", "E\u0301COLE \u00c9cole"]
    for text in texts:
        assert own.encode_all([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = by_id(wavelet.read_shards(spark, wavelet.write_shards(docs, store.new_dir(spark, "t"), path, end_id=1)))
    start = 0
    for i, text in enumerate(texts):
        n = len(library.encode(text, add_special_tokens=False).ids) + 1
        assert (got[i]["start"], got[i]["n_tokens"]) == (start, n)
        start += n


def test_shards_follow_each_other(spark):
    docs = spark.range(1000).selectExpr("id as doc_id", "concat('word ', id) as text")
    manifest = wavelet.write_shards(docs, store.new_dir(spark, "t"), queries.tokenizer_path(queries.WORD_MODEL), shard_tokens=200)
    assert manifest.count() > 3
    rows = sorted(wavelet.read_shards(spark, manifest).collect(), key=lambda r: r["doc_id"])
    assert len(rows) == 1000 and all(b["start"] == a["start"] + a["n_tokens"] for a, b in itertools.pairwise(rows))


def test_wavelet_rank_and_select():
    rng = np.random.default_rng(3)
    tokens = rng.choice([3, 7, 9, 4000, 70_000], 3000).astype(np.uint32)
    shard = wavelet.Shard.of([1], np.asarray([3000]), tokens)
    for i in rng.integers(0, 3000, 60).tolist():
        assert shard.token(i) == tokens[i]
        k = int((tokens[:i] == tokens[i]).sum())
        assert shard.count(int(tokens[i]), i) == k and shard.occurrence(int(tokens[i]), k) == i
    assert shard.count(5) == 0 and shard.occurrence(3, 10_000) == -1


def test_warc_round_trip(spark):
    rows = [(1, "http://a/\nx", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"), (5, "u", "z" * 200_000), (5, "u", "z" * 200_000), (None, "n", "<p>é</p>")]
    table = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, record_type string")
    manifest = warc.write_warc(table, store.new_dir(spark, "w"), roll_bytes=300)
    records = warc.read_warc(spark, manifest).collect()
    got = {r["page_id"]: r for r in records}
    assert len(records) == len(rows) and len(got) == 6 and manifest.count() > 1
    for i, url, html in rows:
        payload = (html or "").encode()
        assert got[i]["payload_bytes"] == len(payload) and got[i]["payload_digest"] == warc.sha1_base32(payload) and got[i]["url"] == (url or "")
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == {
        1: ("revisit", 4), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("response", None), None: ("revisit", 4),
    }
    assert got[5]["payload"] == "z" * 200_000
    again = warc.write_warc(table, store.new_dir(spark, "w"), min_bytes=1)
    assert [r["record_type"] for r in warc.read_warc(spark, again).where("payload_bytes = 0").collect()] == ["response"] * 2
    assert warc.read_warc(spark, warc.write_warc(table.where("false"), store.new_dir(spark, "w"))).count() == 0


def test_warc_payloads_of_one_page_id(spark):
    rows = [(5, "u", "A"), (5, "u", "B"), (5, "v", "A"), (9, "u", "A"), (None, "n", "A"), (None, "n", "C"), (None, "m", "D"), (None, "n", "D"), (6, "u", "C"), (7, "u", "C")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = warc.read_warc(spark, warc.write_warc(table, store.new_dir(spark, "w"))).collect()
    names = {warc.sha1_base32(x.encode()): x for x in "ABCD"}
    revisits = {(5, "u", "A"): 9, (5, "v", "A"): 9, (None, "n", "A"): 9, (None, "n", "C"): 7, (6, "u", "C"): 7}
    assert len(got) == len(rows)
    for r in got:
        row = (r["page_id"], r["url"], names[r["payload_digest"]])
        assert row in rows and r["refers_to"] == revisits.get(row)
        assert (r["record_type"], r["payload"]) == (("revisit", None) if row in revisits else ("response", row[2]))


def test_quality_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, None, 0), (5, 1, 0), (5, 1, 0), (11, 0, 0), (99, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = quality.features(docs.union(docs.where("doc_id = 5")))
    model = quality.train(found, labels)
    scores = quality.score(found, model).collect()
    assert len(scores) == len(EDGE) + 1 and all(0 <= r["score"] <= 1 for r in scores)
    assert quality.score(quality.features(empty), model).count() == 0
    assert quality.score(found, quality.train(found, labels.where("false"))).where("score < 0.7").count() == 0
    # a row's score is its own text's, and carries the row's columns
    beside = quality.with_score(docs, model, "rank").collect()
    assert beside[0].__fields__ == [*docs.columns, "rank"]
    assert {(r["doc_id"], r["text"], r["rank"]) for r in beside} == {(r["doc_id"], t, r["score"]) for r in scores for i, t, *_ in EDGE if i == r["doc_id"]}


def plain_features(text):
    """The features by their definitions, one word at a time."""
    raw = [w.encode() for w in words(text)]
    if not raw:
        return [0.0] * len(quality.FEATURES)
    every = (text or "").encode()
    share = lambda chars, among: sum(every.count(bytes([c])) for c in chars) / among
    n, upper, lower = len(raw), range(0x41, 0x5B), range(0x61, 0x7B)
    count = lambda w, chars: sum(c in chars for c in w)
    caps = [count(w, upper) >= 2 and not count(w, lower) for w in raw]
    symbols, bars = [count(w, b"#*$%&<>@^~+=_{}[]\\/") > 0 for w in raw], [b"|" in w for w in raw]
    again = [k > 0 and w == raw[k - 1] for k, w in enumerate(raw)]
    lines = [x for x in (WORD.findall(ln) for ln in (text or "").split("\n")) if x]
    whole = [re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", ln) for ln in (text or "").split("\n")]
    whole = [ln for ln in whole if ln]
    mean = sum(map(len, raw)) / n
    letters = max(1, sum(count(w, upper) + count(w, lower) + count(w, range(0x80, 0x100)) for w in raw))
    pairs = list(zip(raw, raw[1:]))

    def worst(marks):
        parts = [marks[k:k + 24] for k in range(0, n, 24)]
        return max(sum(p) / max(len(p), 12) for p in parts)

    values = [
        math.log1p(n) / 6, mean / 10, math.sqrt(max(sum(len(w) ** 2 for w in raw) / n - mean**2, 0)) / 6, sum(count(w, upper) for w in raw) / letters, sum(caps) / n,
        share(range(0x30, 0x3A), len(every)), min(1, 4 * share(b"#*$%&<>@^~+=_{}[]\\/", len(every))), min(1, 4 * share(b"!?", len(every))), sum(bars) / n,
        min(1, 4 * share(b".,;:'\"()-", len(every))), len(set(raw)) / n, max(collections.Counter(raw).values()) / n, sum(again) / n,
        len(set(pairs)) / max(1, n - 1), min(1, n / len(lines) / 40), 1 - len(set(whole)) / len(whole), sum(ln[-1] in ".!?" for ln in whole) / len(whole),
        share(range(0x80, 0x100), len(every)), sum(w[0] in upper for w in raw) / n, worst(caps), worst(symbols), worst(again), worst(bars),
    ]
    return [min(2, v) for v in values]


def test_features_by_their_definitions(spark):
    rng = np.random.default_rng(6)
    pool = ["the", "The", "NASA", "x1", "7", "é", "a|b", "|", "#", "end.", "why?", "no!", "(so)", "\n", "\n\n", " ", "\t", "ÀB", "漢字", "{}", "the"]
    texts = [t for _, t, *_ in EDGE] + [" ".join(rng.choice(pool, rng.integers(0, 120))) for _ in range(200)]
    got = quality.feature_rows(texts)
    for row, text in zip(got, texts, strict=True):
        want = plain_features(text)
        assert all(abs(a - b) < 1e-9 for a, b in zip(row, want, strict=True)), [(f, a, b) for f, a, b in zip(quality.FEATURES, row, want, strict=True) if abs(a - b) >= 1e-9]
    # in pieces, as tasks do
    parts = [quality.feature_rows(texts[s:s + n]) for s, n in quality.words.pieces(pa.array(texts), most_bytes=500, most_rows=7)]
    assert np.abs(np.concatenate(parts) - got).max() < 1e-9 and len(parts) > 20


def test_fit_against_slow_descent():
    rng = np.random.default_rng(9)
    x = rng.random((80, 3))
    y = (x @ [2.0, -1.0, 0.5] + 0.3 * rng.normal(size=80) > 0.7).astype(int)
    w = quality.fit(x, y, pairs=400)
    again = np.random.default_rng(7)
    good, bad = x[y == 1], x[y == 0]
    d = good[again.integers(0, len(good), 400)] - bad[again.integers(0, len(bad), 400)]
    slow = np.zeros(3)
    for _ in range(20_000):
        slow += 0.01 * (d.T @ (1 / (1 + np.exp(d @ slow))) - 3.0 * slow)
    assert np.abs(w - slow).max() < 1e-6


def test_quality_threshold_covers_all_labelled_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join("WORD!" if rng.random() < (0.3 if i % 3 else 0.6) else f"w{j}" for j in range(rng.integers(20, 60)))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)], "doc_id bigint, quality int")
    model = quality.train(quality.features(docs), labels, per_class=20)
    mine = [i for i in range(600) if not quality.crc_held_out(i)]
    s = np.sort(quality.feature_rows([rows[i][1] for i in mine]) @ model.weights)
    low = sum(i % 3 == 0 for i in mine)
    assert abs(model.threshold - (s[low - 1] + s[low]) / 2) < 1e-9
    # the same by ranges, with ties, and with rows of a label that weigh more
    y = rng.integers(0, 2, 3000)
    s = np.round(rng.normal(size=3000), 2)
    table = spark.createDataFrame(list(zip(y.tolist(), s.tolist(), strict=True)), "y int, s double")
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    for low, high in ((n0, n1), (1, 9), (9, 1)):
        order = np.lexsort((y, s))
        at = int(np.searchsorted(np.cumsum(np.where(y[order] == 0, low * n1, high * n0)), low * n0 * n1))
        want = (s[order[at]] + s[order[at + 1]]) / 2
        assert {abs(quality.threshold(table, low, high, bins) - want) < 1e-9 for bins in (7, 300, 4096)} == {True}


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01"])
def test_quality_of_held_out_documents(spark, sf_dir):
    scored = queries.queries()["op7_quality"](spark, sf_dir).where("held_out").join(store.read_table(spark, sf_dir, "labels"), "doc_id")
    rows = scored.select("score", "quality", "predicted").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    auc = np.mean([a > b for a in good for b in bad])
    assert auc > 0.95 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
