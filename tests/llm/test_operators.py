"""The operators against brute force, and the defined results of odd inputs."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from math import comb, log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from auditmill.llm import bpe, chat, exact_dedup, jaccard_join, language_model, packing, quality, toxicity, url_filter, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_words string, row bigint"


@pytest.fixture(scope="module")
def rows():
    """Nulls, blanks, repeats, ties, a very long text, near copies; `n_words` and `row` clash with internal names."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [prose(rng.randint(55, 200)) for _ in range(25)]
    out = [(i, t, "en", "a", "x", 1) for i, t in enumerate(base)]
    for i in range(12):  # near copies of one text, each with another word changed
        w = base[0].split()
        w[3 * i] = f"changed{i}"
        out.append((100 + i, " ".join(w), "en", "a", "x", 1))
    out += [(200, base[1], "de", "a", None, None), (201, base[1] + " \n", "de", "a", None, None), (200, base[1], "de", "a", None, None)]
    out += [(300, None, None, None, None, None), (301, "", "xx", None, None, None), (None, " \t ", "en", None, None, None)]
    out += [(400, prose(5000), "fr", "b", "x", 2), (401, "one two", "fr", "b", "x", 2), (402, "one two", "fr", "b", "x", 2)]
    out += [(403, "a b c a b c a b c x\nline\nline\n\n line\r", "fr", "b", "x", 2), (404, "é" * 300 + " it's <|endoftext|> 12", "en", "b", "x", 2)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels_of(spark, rows, toxic=lambda i: 0, quality_=lambda i: 1):
    data = [(i, quality_(i), toxic(i)) for i, *_ in rows]
    return spark.createDataFrame(data, "doc_id bigint, quality int, toxic int")


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


# --- Exact dedup ---------------------------------------------------------------------------------------------------


def test_exact_groups(docs, rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[normal(t)].append((-len(t or ""), i is None, i or 0, i))
    got = exact_dedup.exact_groups(docs).collect()
    want = Counter((i, min(groups[normal(t)])[3], len(groups[normal(t)]), hashlib.sha256(normal(t).encode()).hexdigest()) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_drop_copies_keeps_columns(docs, rows):
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len({normal(t) for _, t, *_ in rows})


def test_live_index_inserts_deletes_and_grows():
    index, live = exact_dedup.LiveIndex(buckets=4), {}
    rng = random.Random(1)
    for step in range(5000):
        digest = hashlib.sha256(str(rng.randrange(900)).encode()).digest()
        if rng.random() < 0.4:
            assert index.remove(digest) == (digest in live)
            if digest in live:
                live[digest] -= 1
                if not live[digest]:
                    del live[digest]
        else:
            index.add(digest, 1, (step,))
            live[digest] = live.get(digest, 0) + 1
    assert {d: n for d, n, _ in index.items()} == live and index.resizes > 0
    assert all(index.find(d) for d in live)


def test_deletions_of_best_rows(spark, docs, rows):
    """Groups after deletions, those of every group's best row included, against brute force."""
    keyed = exact_dedup.keyed(docs)
    every = keyed.collect()
    rank = lambda r: (-r.chars, r.doc_id is None, r.doc_id or 0, r.row)
    groups = defaultdict(list)
    for r in every:
        groups[bytes(r.digest)].append(r)
    gone = {min(g, key=rank).row for g in groups.values()} | {r.row for r in every if r.row % 5 == 0}
    want = {}
    for digest, g in groups.items():
        live = [r for r in g if r.row not in gone]
        if live:
            want[digest] = len(live), min(live, key=rank).row
    named = spark.createDataFrame([(r,) for r in gone] * 2, "row bigint")
    got = exact_dedup.groups_after_deletion(keyed, named).collect()
    assert {bytes(r.digest): (r.n, r.row) for r in got} == want and len(got) == len(want) > 0
    assert exact_dedup.groups_after_deletion(keyed, keyed.select("row")).count() == 0
    nothing = exact_dedup.groups_after_deletion(keyed, named.where("false")).collect()
    assert sorted((bytes(r.digest), r.n, r.row) for r in nothing) == sorted((k, len(g), min(g, key=rank).row) for k, g in groups.items())


# --- Quality -------------------------------------------------------------------------------------------------------


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_figures(spark, docs, rows):
    got = quality.quality_verdicts(docs, labels_of(spark, rows)).collect()
    want = Counter((i, *brute_quality(t)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert all(r.kept == (not r.base_failed) for r in got)  # too few labels certify nothing


def test_cutoffs_are_certified_exactly(spark):
    tail = lambda k, n, p: sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    cases = spark.createDataFrame([(k, n) for n in (1, 40, 900) for k in (0, 1, 5) if k <= n], "k bigint, n bigint")
    for r in cases.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).collect():
        assert r.p == pytest.approx(1.0 if r.k >= r.n * 0.02 else tail(r.k, r.n, 0.02))
    rungs = [0] * len(quality.LADDERS)
    good = spark.createDataFrame([("en", [3, *rungs[1:]] if i < 100 else rungs) for i in range(4000)], "stratum string, rungs array<int>")
    (row,) = quality.certified(good).collect()
    assert row.stratum == "en" and row.cutoffs[0] == 4 and row.cutoffs[1] == 1  # 2.5 % of good documents stand on rung 3


def test_verdicts_with_active_cutoffs(spark):
    """Enough good documents to certify cutoffs; verdicts against cutoffs and rungs recomputed here."""
    rng = random.Random(12)

    def text(kind):
        words = [f"w{rng.randrange(4000)}" for _ in range(70)]
        if kind == "symbols":
            words = [w + "###" if i % 2 else w for i, w in enumerate(words)]
        if kind == "capitals":
            words = [w.upper() for w in words]
        return " ".join(words)

    kinds = ["symbols" if i % 50 == 0 else "capitals" if i % 35 == 1 else "plain" for i in range(4000)]
    rows = [(i, text(k), "en" if i % 4 else "fr") for i, k in enumerate(kinds)]
    good = {i for i, k in enumerate(kinds) if (k == "plain" or i % 700 == 0) and i % 3}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    labels = spark.createDataFrame([(i, int(i in good)) for i in range(4000) if i % 3], "doc_id bigint, quality int")
    got = {r.doc_id: r.kept for r in quality.quality_verdicts(docs, labels).collect()}

    def figures(t):
        words = WORD.findall(t)
        chars = sum(map(len, words))
        lines = [x for x in t.split("\n") if WORD.search(x)]
        return {
            "symbols_per_char": sum(t.count(c) for c in "#*$%&|<>") / chars, "dup_line_share": (len(lines) - len(set(lines))) / len(lines),
            "repeat_word_share": brute_quality(t)[4] / len(words), "chars_per_word": chars / len(words),
            "capital_share": sum("A" <= c <= "Z" for c in t) / chars, "shouts_per_word": t.count("!") / len(words),
        }

    told = {i: (lang, figures(t), len(WORD.findall(t)) >= 50) for i, t, lang in rows}
    rules, tests = len(quality.LADDERS), len(quality.LADDERS) * (len(quality.STRATA) + 1)
    tail = lambda k, n: sum(comb(n, i) * (a := quality.ALPHA / rules) ** i * (1 - a) ** (n - i) for i in range(k + 1))
    cutoffs = {}
    for lang in ("en", "fr"):
        own = [told[i][1] for i in good if told[i][0] == lang]
        for rule, ladder in quality.LADDERS.items():
            passed = [c for c in ladder if (k := sum(f[rule] > c for f in own)) < len(own) * quality.ALPHA / rules and tail(k, len(own)) <= quality.DELTA / tests]
            cutoffs[lang, rule] = min(passed, default=None)
    active = {k: c for k, c in cutoffs.items() if c is not None}
    want = {i: fine and not any(f[r] > c for (g, r), c in active.items() if g == lang) for i, (lang, f, fine) in told.items()}
    assert got == want and active
    assert 20 < sum(not kept for kept in got.values()) < 700


# --- Toxicity ------------------------------------------------------------------------------------------------------


def test_toxicity_separates_and_ignores_held_out_labels(spark):
    rng = random.Random(5)
    plain, bad = [f"w{i}" for i in range(200)], ["vile", "awful", "nasty"]
    data = []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(60)]
        if i % 4 == 0:
            for at in rng.sample(range(60), 5):
                words[at] = rng.choice(bad)
        data.append((i, " ".join(words)))
    docs = spark.createDataFrame([*data, (None, None), (5000, "")], "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(900)] + [(7, None)], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert len(got) == 902 and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i in range(900) if got[i].held_out} == set(held)
    assert np.mean([got[i].predicted == (i % 4 == 0) for i in held]) > 0.97
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, flipped).collect()}
    assert all(again[i] == pytest.approx(got[i].score) for i in got)


def test_toxicity_counts_phrases_whose_second_word_follows_one_word(spark):
    rng = random.Random(6)
    plain = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        rows.append((int(i % 4 == 0), " ".join(words + (["w1", "phrase"] * 2 if i % 4 == 0 else ["w1", "w2"]))))
    docs = spark.createDataFrame(rows, "toxic int, text string").select("toxic", toxicity.token_hashes(F.col("text")).alias("hashes"))
    model = toxicity.fit_counts(docs)
    asked = spark.createDataFrame([("w1 phrase",), ("w7 phrase",)], "text string").select(toxicity.token_hashes(F.col("text")).alias("h"))
    seen, unseen = (model.ratios(np.array(r.h, np.int64), np.array([0]))[1] for r in asked.collect())
    assert seen > 2 and unseen == 0


def test_toxicity_counts_equal_kneser_ney_sums(spark):
    """Every ratio against sums over plain dictionaries."""
    rng = random.Random(8)
    rows = [(int(i % 3 == 0), [rng.choice("abcdefgh" if i % 3 else "abcxyzgh") for _ in range(rng.randrange(0, 40))]) for i in range(120)]
    rows.append((1, ["only", "once"]))
    d, start = toxicity.DISCOUNT, None
    pairs, words = [Counter(), Counter()], [Counter(), Counter()]
    for toxic, text in rows:
        pairs[toxic].update(zip([start, *text], text))
        words[toxic].update(text)
    types = {(h, w) for c in pairs for h, w in c}
    contexts = Counter(w for _, w in types)
    n = [sum(c.values()) for c in words]
    shared = {w: k / len(types) for w, k in contexts.items()}
    alone = lambda y, w: max(words[y][w] - d, 0) / n[y] + d * len(words[y]) / n[y] * shared[w]
    p = lambda y, w: alone(y, w) if contexts[w] >= toxicity.MIN_CONTEXTS else shared[w]
    follow = [Counter(), Counter()], [Counter(), Counter()]
    for y in (0, 1):
        for (h, _), c in pairs[y].items():
            follow[0][y][h] += c
            follow[1][y][h] += 1
    weight = lambda y, h: d * follow[1][y][h] / follow[0][y][h] if follow[0][y][h] else 1.0
    after = lambda y, h, w: max(pairs[y][h, w] - d, 0) / follow[0][y][h] + weight(y, h) * p(y, w) if follow[0][y][h] else p(y, w)
    docs = spark.createDataFrame([(t, " ".join(x)) for t, x in rows], "toxic int, text string")
    model = toxicity.fit_counts(docs.select("toxic", toxicity.token_hashes(F.col("text")).alias("hashes")))
    hashed = spark.createDataFrame([(w,) for w in contexts], "w string").select("w", F.xxhash64("w").alias("h")).collect()
    key = {r.w: r.h for r in hashed} | {start: 0}
    signed = lambda x: (x + 2**63) % 2**64 - 2**63
    frequent = {t for t in types if pairs[0][t] + pairs[1][t] >= toxicity.MIN_PAIR}
    want = {signed(key[h] * toxicity.PAIR_FACTOR + key[w]): math.log(after(1, h, w) / after(0, h, w)) for h, w in frequent}
    assert len(want) > 20 and dict(zip(model.pair_keys.tolist(), model.pair_ratio)) == pytest.approx(want)
    common = {key[w]: math.log(p(1, w) / p(0, w)) for w, k in contexts.items() if k >= toxicity.MIN_CONTEXTS}
    assert dict(zip(model.word_keys.tolist(), model.word_ratio)) == pytest.approx(common)
    before = {key[h]: math.log(weight(1, h) / weight(0, h)) for h in {h for h, _ in types} if weight(0, h) != weight(1, h)}
    assert dict(zip(model.context_keys.tolist(), model.context_ratio)) == pytest.approx(before)


def test_toxicity_carries_any_column(spark):
    """Names with blanks and points, names of its own, and nested values stay as they are."""
    rows = [(i, "vile awful" if i % 2 else "nice day", i, {"a": [i]}, "s") for i in range(80)] + [(None, None, 1, None, None)]
    schema = "doc_id bigint, text string, `my col.x` int, `a b` map<string, array<int>>, score string"
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame(rows, schema).repartition(3)
    kept = toxicity.drop_toxic(docs, labels)
    verdicts = {r.doc_id for r in toxicity.toxicity_scores(docs, labels).where("predicted = 0").collect()}
    assert kept.schema == docs.schema
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in docs.collect() if r.doc_id in verdicts)


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.toxicity_scores(docs, none).collect()} == {0.0}
    assert toxicity.drop_toxic(docs, none).columns == docs.columns


# --- Packing and BPE -----------------------------------------------------------------------------------------------


def test_packing_places_every_id_once(docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.packed(docs, path).collect()
    lengths = Counter()
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == lengths[r.sequence_id]
        lengths[r.sequence_id] += r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values()) and max(lengths.values()) <= 2048
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t, *_ in rows}
    covered = Counter()
    for r in pieces:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        covered[r.doc_id] += r.length
    copies = Counter(i for i, *_ in rows)
    assert all(covered[i] == copies[i] * len(ids[i]) for i in ids)


def test_packer_minimises_the_sum_of_squares():
    packer, rng = packing.Packer(32), random.Random(2)
    for n in range(400):
        size = rng.randint(1, 31)
        counts = packer.counts.copy()
        cost = {}
        for level in [0, *np.flatnonzero(counts)]:
            if level + size <= 32:
                after = counts.copy()
                after[level] -= level > 0
                after[level + size] += level + size < 32
                cost[level] = int((after**2).sum())
        assert cost[packer._best(size)] == min(cost.values())
        list(packer.add(n, size))


def test_bpe_equals_the_library(docs, rows):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    want = Counter()
    for i, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    got = bpe.round_trip(docs, path, public_tokenizers.PATTERN).collect()
    assert Counter(map(tuple, got)) == want


def test_bpe_long_words_take_the_heap():
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rng = random.Random(4)
    for word in ("the" * 30, "".join(rng.choice("ereinst") for _ in range(99)), "é" * 40):
        assert bpe._fold_long(word.encode(), ranks) == bpe.fold(word.encode(), ranks)


# --- Archives ------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark, tmp_path):
    data = [(5, "http://a/%0A", "<p>x</p>\r\n\r\nWARC/1.1 é"), (3, None, "<p>x</p>\r\n\r\nWARC/1.1 é"), (9, "u\nv", None), (8, "", "")]
    data += [(10 + i, f"http://h/{i}", "hot") for i in range(50)] + [(2, "t", "big" * 100_000), (2, "t", "big" * 100_000)]
    pages = spark.createDataFrame(data, "page_id bigint, url string, html string").repartition(4)
    first = {}
    for i, _, html in data:
        first[html or ""] = min(first.get(html or "", 1 << 60), i)
    want = Counter()
    for i, _, html in data:
        payload = (html or "").encode()
        origin = first[html or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want[i, len(payload), digest, "response" if i == origin else "revisit", None if i == origin else origin] += 1
    assert Counter(map(tuple, warc.round_trip(pages).collect())) == want
    folder = str(tmp_path / "archives")
    index = warc.write_archives(pages, folder)
    some = index.where("page_id IN (3, 9, 5)")
    records = {r.page_id: r for r in warc.read_records(some, folder).collect()}
    assert records[3].payload.decode() == data[0][2] and records[9].url == "u\nv" and records[5].record_type == "revisit"
    one = index.where("page_id = 3").first()
    with open(f"{folder}/{one.archive}", "rb") as file:
        file.seek(one.offset)
        assert gzip.decompress(file.read(one.length)).startswith(b"WARC/1.1\r\n")


# --- Language model ------------------------------------------------------------------------------------------------


def test_language_model_base_and_bounds(docs, rows):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(i, WORD.findall((t or "").translate(small)) + [" "]) for i, t, *_ in rows]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    counts = Counter(w for i, t in tokens if not held(i) for w in t)
    total = sum(counts.values())
    norm = log10(total + 0.5 * (len(counts) + 1))
    want = sorted((repr(i), held(i), len(t), sum(counts[w] > 0 for w in t), total, round(sum(log10(counts[w] + 0.5) - norm for w in t), 4)) for i, t in tokens)
    got = language_model.language_model_scores(docs).collect()
    assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_language_model_learns_from_every_training_document(spark):
    """A word's embedding moves only if its document was learned from, also when the corpus is large."""
    docs = spark.createDataFrame([(i, f"own{i} " * 4000) for i in range(40)], "doc_id bigint, text string").repartition(4)
    tokens = language_model.split(docs)
    counts = language_model.totals(language_model.word_counts(tokens), 32)
    counts.tokens = 10**8
    shared = spark.sparkContext.broadcast(vars(counts))
    trained = language_model.unpacked(language_model.train(tokens, counts, shared))
    before = language_model.initial(counts.model_counts)
    hashes = [r.h for r in tokens.where("NOT held_out").selectExpr("hashes[0] AS h").collect()]
    ids = counts.model_ids(np.array(hashes))
    assert len(ids) > 20 and (ids > 1).all()
    assert (np.abs(trained["embed"][ids] - before["embed"][ids]).max(1) > 1e-4).all()


def test_language_model_gradients_and_carried_state():
    rng = np.random.default_rng(0)
    params = {k: (rng.standard_normal(s) * 0.3).astype(np.float32) for k, s in language_model.SHAPES.items()}
    tokens = rng.integers(0, language_model.WORDS, 700)
    whole = language_model.scored_documents(params, [tokens, tokens[:5]])
    h, previous, want = np.zeros((1, language_model.HIDDEN), np.float32), 1, 0.0
    for y in tokens:
        x = params["embed"][[previous]] @ params["w"] + params["b"]
        h = language_model.gates(params, x, h)[0]
        want += language_model.log_probs(params, h, np.array([y]))[0]
        previous = y
    assert whole[0] == pytest.approx(want, rel=1e-4)
    own, captured = tokens[:20], {}
    trainer = language_model.Trainer({k: v.astype(np.float64) for k, v in params.items()})
    trainer._update = lambda grads, n: captured.update(grads)
    trainer.learn(own, np.arange(20) == 0)
    loss = lambda p: -language_model.scored_documents(p, [own])[0]
    for name, at in (("embed", (own[3], 2)), ("w", (1, 5)), ("u", (4, 20)), ("u", (3, 40)), ("b", (17,)), ("class_w", (0, 1)), ("word_b", (own[0] // 32, 1))):
        sides = []
        for step in (1e-2, -1e-2):
            moved = {k: v.astype(np.float64) for k, v in params.items()}
            moved[name][at] += step
            sides.append(loss(moved))
        assert captured[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-2, rel=0.03, abs=3e-3)


# --- Chat ----------------------------------------------------------------------------------------------------------


def test_chat_events_fold(spark):
    log = [("open", "assistant", None), ("delta", None, "wro"), ("regenerate", None, None), ("delta", None, "ri"), ("delta", None, "ght")]
    edited = [("open", "user", "helo"), ("edit", None, "hello")]
    data = [(1, 2, s, *e) for s, e in enumerate(log)] + [(1, 1, s, *e) for s, e in enumerate(edited)] + [(2, 1, 0, "delta", None, "x")]
    events = spark.createDataFrame(data, "conv_id int, message int, seq int, event string, role string, text string").repartition(3)
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold_events(events).collect()}
    assert got == {(1, 1): ("user", "hello"), (1, 2): ("assistant", "right"), (2, 1): ("", "x")}


def test_chat_reads_back(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<||", "<", None, "", "a\n\n<|n|>", "x" * 2001, "é<|" * 300]
    data = [(c, t, role, text) for c in (1, None) for t, (role, text) in enumerate(zip(["user", "assistant", "sys\ntem", None] * 2, nasty))]
    data += [(3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    rows = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    got = {r.conv_id: r for r in chat.read_back(chat.formatted_conversations(rows)).collect()}
    for c in (1, None, 3):
        turns = [(role or "", text or "") for conv, _, role, text in data if conv == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


# --- URL filter ----------------------------------------------------------------------------------------------------


def brute_rule(url):
    _, there, rest = (url or "").partition("://")
    host = re.match(r"[^/?#]*", rest).group() if there else ""
    path = re.match(r"[^?#]*", rest[len(host) :]).group() if there else ""
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *((max(fits)[1], max(fits)[2]) if fits else (None, None))


def test_url_verdicts(spark):
    urls = [None, "", "nohost", "http://A.Example.ORG/es/1?x=1#f", "https://example.org/en/12", "http://org/", "http://xorg/", "http://a.org"]
    urls += [f"http://h{i}.example.{s}/{p}/{i}" for i in range(40) for s in ("com", "net", "org") for p in ("fr", "de", "es")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").repartition(3)
    got = {r.page_id: r for r in url_filter.url_verdicts(pages).collect()}
    for i, url in enumerate(urls):
        host, path, rule, verdict = brute_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    labelled = spark.createDataFrame([(f"http://bad-{i}-{i}.zz/?a=1&b=2", 1) for i in range(60)] + [(f"http://good{i}.yy/p", 0) for i in range(60)], "url string, label int")
    asked = spark.createDataFrame([(1, "http://bad-99-99.zz/?a=1&b=2"), (2, "http://good99.yy/p")], "page_id bigint, url string")
    assert {r.page_id: r.verdict for r in url_filter.url_verdicts(asked, (), labelled).collect()} == {1: "block", 2: "allow"}


def test_copies_of_one_url_teach_once(spark):
    """Thirty thousand copies of the URL that the sample would take first leave the other verdicts as they are."""
    urls = [f"http://h{i}.example.{s}/{p}/{i}" for i in range(40) for s in ("com", "net", "org") for p in ("fr", "de", "es")]
    asked = ["http://x.net/de/", "http://y9.example.net/es/4", "http://q.com/de/7", None]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, *asked])], "page_id bigint, url string")
    first = rows.where("url IS NOT NULL AND url LIKE '%.com/%'").orderBy(F.xxhash64("url")).first().url
    copies = spark.range(100_000, 130_000).select(F.col("id").alias("page_id"), F.lit(first).alias("url"))
    told = lambda df: {r.page_id: (r.verdict, r.block_score) for r in url_filter.url_verdicts(df).collect()}
    plain, crowded = told(rows), told(rows.unionByName(copies))
    assert {i: v for i, v in crowded.items() if i < 100_000} == plain and len(crowded) == len(plain) + 30_000
    assert len({v for _, v in plain.values()}) > 2


def test_every_labelled_url_teaches(spark, monkeypatch):
    seen = []

    class Watched(url_filter.GBTClassifier):
        def fit(self, rows):
            seen.append((rows.count(), rows.agg(F.sum("label")).first()[0]))
            return super().fit(rows)

    monkeypatch.setattr(url_filter, "GBTClassifier", Watched)
    labelled = spark.range(25_000).selectExpr("concat('http://h', id, if(id % 5 = 0, '.zz/', '.yy/'), id) AS url", "CAST(id % 5 = 0 AS INT) AS label")
    asked = spark.createDataFrame([(1, "http://a.zz/1"), (2, "http://a.yy/1"), (3, "http://a.ww/1")], "page_id bigint, url string")
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(asked, (), labelled.unionByName(labelled)).collect()}
    assert seen == [(25_000, 5_000.0)] and got[1] == "block" and got[2] == "allow" and len(got) == 3



def test_scoring_windows_bound_memory():
    """Many documents that run at once make narrower windows; each is scored as it is alone."""
    import tracemalloc

    pick = np.random.default_rng(5)
    params = language_model.initial(np.ones(language_model.WORDS))
    params["word_w"] += pick.standard_normal(params["word_w"].shape).astype(np.float32)
    documents = [pick.integers(1, language_model.WORDS, int(n)).astype("<u2") for n in pick.integers(120, 140, 4000)]
    tracemalloc.start()
    scores = language_model.scored_documents(params, documents)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6
    for i in (0, 1, 3999):
        assert abs(language_model.scored_documents(params, [documents[i]])[0] - scores[i]) < 1e-2



# --- Jaccard join --------------------------------------------------------------------------------------------------


def brute_classes(rows):
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall(t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)})
    n = len(rows)
    linked = [[i != j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    root = list(range(n))
    for _ in range(n):
        root = [min([root[i], *(root[j] for j in range(n) if linked[i][j])]) for i in range(n)]
    members = defaultdict(list)
    for i, r in enumerate(root):
        members[r].append(rows[i][0])
    name = {r: min((m for m in ms if m is not None), default=None) for r, ms in members.items()}
    return Counter((rows[i][0], name[root[i]], len(members[root[i]]), sum(linked[i])) for i in range(n))


def test_jaccard_classes(docs, rows):
    assert Counter(map(tuple, jaccard_join.similarity_classes(docs).collect())) == brute_classes(rows)


def test_jaccard_splits_large_buckets_and_blocks(spark, rows, monkeypatch):
    for name, value in (("BUCKET", 3), ("BLOCK", 4), ("CLUSTER_BLOCK", 4)):
        monkeypatch.setattr(jaccard_join, name, value)
    docs = spark.createDataFrame(rows, DOCS).repartition(2)
    assert Counter(map(tuple, jaccard_join.similarity_classes(docs).collect())) == brute_classes(rows)


def test_keep_one_of_each_class(docs, rows):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(c, n) for _, c, n, _ in brute_classes(rows)})


# --- Empty tables --------------------------------------------------------------------------------------------------


def test_empty_tables(spark):
    none, labels = empty(spark), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert exact_dedup.exact_groups(none).count() == 0
    assert quality.quality_verdicts(none, labels).count() == 0
    assert toxicity.toxicity_scores(none, labels).count() == 0
    assert packing.packed(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert bpe.round_trip(none, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0
    assert language_model.language_model_scores(none).count() == 0
    assert jaccard_join.similarity_classes(none).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.round_trip(pages).count() == 0 and url_filter.url_verdicts(pages).count() == 0
    assert chat.read_back(chat.formatted_conversations(spark.createDataFrame([], "conv_id int, turn int, role string, text string"))).count() == 0


def test_language_model_words_are_cut_and_hashed_like_spark(spark):
    """Words of all lengths, wide characters and other white space; empty texts, slices, and texts that meet without a blank."""
    rng = random.Random(7)
    words = ["".join(rng.choice("aBZé漢\xa0 \x1fx0") for _ in range(n)) for n in [*range(1, 120), 700, 3000]]
    texts = ["dropped", " ".join(words), "", "\t\n", "ab", "cd \x0b", " \r\x0c\nE e", None, "x" * 33 + "\n" + "x" * 33]
    held = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hashed = F.transform(F.regexp_extract_all(small, F.lit(WORD.pattern), F.lit(0)), lambda w: F.xxhash64(w))
    want = [r[0] or [] for r in held.orderBy("i").select(hashed).collect()][1:]
    column = pa.array([t or "" for t in texts]).slice(1)
    hashes, codes, bounds = language_model.word_hashes(column)
    assert [hashes[codes[a:b]].tolist() for a, b in zip(bounds, bounds[1:])] == want
    assert len(hashes) == len(set(hashes.tolist())) == len({h for own in want for h in own})
    docs = held.select(F.lit(0).alias("doc_id"), "text")
    counted = {r.h: r.c for r in language_model.word_counts(language_model.split(docs)).collect()}
    every = [r[0] or [] for r in held.select(hashed).collect()]
    assert counted == Counter(h for own in every for h in own)
    # What the passes read holds no expression that cuts or hashes whole texts.
    read = language_model.split(docs).select("doc_id", "held_out", "text")
    assert "regexp_extract_all" not in read._jdf.queryExecution().optimizedPlan().toString()
