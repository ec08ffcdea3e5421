"""Each operator against brute force, and on awkward rows: nulls, empties, long texts, repeats."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sentrylake.llm import (
    decontamination,
    exact_dedup,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    quality,
    sharding,
    substring_dedup,
    toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(n, seed):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abcdeÉü"), rng.integers(2, 7))) for _ in range(n)]


def corpus():
    base = words(120, 1)
    texts = [" ".join(words(60 + i, 10 + i)) for i in range(6)]
    texts += [" ".join(base), " ".join(base).upper(), " ".join(base[:118] + ["new", "end"]), " ".join(base[:40] + ["cut"] + base[41:])]
    texts += ["A b c", "a B c", "", None, "  \t\n ", "one", "line one\nline two\nline three\n" * 6 + "last", "x " * 300, "passage " + " ".join(base[20:70]) + "\nother\ntail"]
    texts += ["é" * 40_000 + " z", "\n".join(["same line", "again", "third one", "fourth"] * 9), "\n".join(["top"] + ["same line", "again", "third one", "fourth"] * 9)]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(0, texts[0]), (18, texts[6]), (None, texts[7]), (None, None)]
    return rows


CLASH = ["digest", "names", "band", "key", "start", "rest", "gone", "bucket", "lines", "text_sha256", "terms"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    return frame.select("doc_id", "text", *[F.lit(k).alias(c) for k, c in enumerate(CLASH)]).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(i * 3, i % 2, int(i % 3 == 0)) for i in range(20)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")


def unique(rows):
    return {i: t for i, t in rows if i is not None}


def test_exact(docs, none):
    for bits in (32, 1):  # one byte: digests collide and rows meet by content
        got = exact_dedup.exact_groups(docs, digest_bytes=bits).collect()
        groups = defaultdict(list)
        for i, t in corpus():
            groups[(t or "").translate(LOWER)].append(i)
        assert len(got) == len(corpus())
        for r in got:
            text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
            best = max((i for i in groups[text] if i is not None), default=None)
            assert (r.keep_id, r.group_size, r.kept) == (best, len(groups[text]), r.doc_id == best)
    assert exact_dedup.exact_groups(none).count() == 0
    two = docs.sparkSession.createDataFrame([(1, "a same"), (1, "b other"), (2, "A SAME"), (None, "c"), (3, None)], "doc_id bigint, text string")
    assert sorted(map(str, exact_dedup.deduplicate(two).collect())) == sorted(["Row(doc_id=1, text='b other')", "Row(doc_id=2, text='A SAME')", "Row(doc_id=None, text='c')", "Row(doc_id=3, text=None)"])


def test_shards(spark, docs, none):
    got = sharding.shard_rows(docs, shards=4, buckets=64).collect()
    assert len(got) == len(corpus())
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.size >= 1
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {(r.size, r.text_crc32) for r in got} == {(len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in corpus()}
    assert sharding.shard_rows(none).count() == 0
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    a, b = ({r.doc_id: r.shard for r in sharding.shard_rows(many, shards=n, buckets=512).collect()} for n in (8, 9))
    assert sum(a[i] != b[i] for i in a) < 0.45 * len(a)  # a new shard moves a part, not all


def test_decontamination(spark, docs, none):
    items = [(1, " ".join(words(120, 1)[20:50])), (2, "A, b; C"), (3, None), (4, ""), (10, "one")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    token = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = {}
    for i, t in corpus():
        w = token.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for item, s in items:
            p = token.findall((s or "").translate(LOWER))
            n = min(10, len(p))
            for k in range(len(p) - n + 1 if n else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == p[k : k + n]:
                        hit.update(range(at, at + n))
                        found.add(str(item))
        want[i, t] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    got = decontamination.contamination_report(docs, bench).collect()
    assert Counter((r.doc_id, *r[1:]) for r in map(tuple_of, got)) == Counter((i, *want[i, t]) for i, t in corpus())
    with pytest.raises(ValueError):
        decontamination.scan(docs, bench, most_bytes=10)
    for kind in ("smallint", "decimal(20,0)", "string"):
        typed = decontamination.scan(docs.withColumn("doc_id", F.col("doc_id").cast(kind)), bench)
        assert typed.schema["doc_id"].dataType.simpleString() == kind and typed.where("size(spans) > 0").count() == sum(v[4] for v in (want[i, t] for i, t in corpus()))
    spans = decontamination.scan(docs, bench).where("doc_id = 54").select("spans").first().spans
    text = unique(corpus())[54]
    assert all(text[s.start : s.end].split()[0] == WORD.findall(text)[s.first_word] for s in spans) and spans
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not v for v in (want[i, t][4] for i, t in corpus()))
    assert decontamination.contamination_report(none, bench).count() == 0
    assert decontamination.contamination_report(docs, bench.limit(0)).where("contaminated").count() == 0


def test_automaton_equals_brute_force(monkeypatch):
    """Hits of every pattern, short ones within long ones, overlapping ones, over segments of any size; a word of the text
    that only shares a benchmark word's hash is no hit."""
    rng, real = np.random.default_rng(3), decontamination.word_hashes
    fake = lambda data, a, b: np.array([int(h) if bytes(data[x:y]) != b"zz" else int(real(np.frombuffer(b"aa", np.uint8), np.array([0]), np.array([2]))[0]) for h, x, y in zip(real(data, a, b), a, b)], np.uint64)
    for window, segment, collide in ((4, 3, False), (10, 64, False), (3, 5, True), (1, 4, False)):
        monkeypatch.setattr(decontamination, "_SEGMENT", segment)
        monkeypatch.setattr(decontamination, "word_hashes", fake if collide else real)
        pool = ["aa", "b", "Cc", "d9", "\u00e9", "ff"]
        items = [(str(k), " ".join(pool[j] for j in rng.integers(0, 6, rng.integers(1, 14))).encode()) for k in range(30)] + [("x", b""), ("y", b"--")]
        texts = ["; ".join(pool[j] for j in rng.integers(0, 6, size)) + " zz aa" * (size % 5) for size in (0, 1, 5, 40, 200, 777)]
        made = decontamination.build_automaton(items, window)
        raw = "".join(texts).encode()
        offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
        data, starts, ends, first = decontamination._read(np.frombuffer(raw, np.uint8), offsets)
        last, node = decontamination._found(made, data, starts, ends, first)
        got = {(int(e), int(made.length[v])) for e, v in zip(last, node)}
        word = [bytes(data[a:b]) for a, b in zip(starts, ends)]
        want = set()
        for _, item in items:
            w = item.translate(decontamination._TABLE).split()
            n = min(window, len(w))
            for k in range(len(w) - n + 1 if n else 0):
                for lo, hi in zip(first[:-1], first[1:]):
                    want |= {(at + n - 1, n) for at in range(lo, hi - n + 1) if word[at : at + n] == w[k : k + n]}
        assert got == want and len(last) == len(got)


def test_automaton_size():
    """Bytes for each word of a benchmark of a million words are as stated."""
    rng = np.random.default_rng(6)
    text = " ".join(f"w{j}" for j in rng.integers(0, 50_000, 300_000)).encode()
    made = decontamination.build_automaton([("1", text)], 10)
    held = sum(getattr(made, c).nbytes for c in ("edges", "fail", "length"))
    assert held <= 140 * 300_000 and made.link is None


class tuple_of(tuple):
    doc_id = property(lambda self: self[0])


@pytest.fixture(scope="module")
def tokens():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("word_bpe_49k.json"))


def test_packing(docs, none, tokens):
    size = 64
    got = packing.pack(docs, size=size, open_windows=3, with_ids=True).collect()
    ids = {}
    for i, t in corpus():
        ids.setdefault(i, []).append([*tokens.encode(t or "", add_special_tokens=False).ids, 1])
    total = Counter()
    windows = defaultdict(list)
    for r in got:
        piece = np.frombuffer(r.ids, "<u4").tolist()
        assert any(x[r.start : r.start + r.length] == piece and len(x) == r.doc_tokens for x in ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(r.ids)
        total[r.doc_id] += r.length
        windows[r.sequence_id].append((r.offset, r.length))
    assert total == {i: sum(map(len, x)) for i, x in ids.items()}
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    assert len(windows) <= sum(total.values()) / size * 1.1 + 4
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("text", ["It's 3rd, isn't?! x\x1cy", "naïve ÇA ß", "é <|endoftext|> a", "漢字 ﬁ İ ǅ", "a\x0bb\x0cc d", "½ ²³ ªº ''s"])
def test_tokens(tokens, text):
    from sentrylake.llm.tokens import tokenizer

    assert np.frombuffer(tokenizer("word_bpe_49k.json").ids(text), "<u4").tolist() == tokens.encode(text, add_special_tokens=False).ids


def test_substrings(spark, docs, none):
    # bounds of 0 and 300 bytes: all, or the commoner, suffixes go on to longer prefixes and whole windows
    for frame, rows, window, bound in ((docs, corpus(), 20, None), (docs, corpus(), 20, 0), (docs, corpus(), 20, 300), (docs, corpus(), 5, 40)):
        seen, want = {}, Counter()
        order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
        texts = defaultdict(list)
        for _, i, t in order:
            texts[i].append(t)
        for flag, i, t in order:
            w = WORD.findall(t)
            for k in range(len(w) - window + 1):
                seen.setdefault(tuple(w[k : k + window]), (flag, i, t, k))
        for i, t in rows:
            if len(texts[i or 0]) > 1 and i is None:
                continue  # two texts under the null id: told apart by hash, checked by size below
            w, gone = WORD.findall(t or ""), set()
            for k in range(len(w) - window + 1):
                if seen[tuple(w[k : k + window])] != (i is not None, i or 0, t or "", k):
                    gone.update(range(k, k + window))
            left = " ".join(x for k, x in enumerate(w) if k not in gone)
            want[i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()] += 1
        got = substring_dedup.remove_repeats(frame, window=window, **({} if bound is None else {"group_bytes": bound})).collect()
        assert len(got) == len(rows)
        assert Counter(tuple(r) for r in got if r.doc_id is not None) == Counter({k: v for k, v in want.items() if k[0] is not None})
    assert substring_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("seed, letters, cut", [(1, 2, 1 << 20), (2, 3, 1), (3, 2, 200), (4, 40, 1)])
def test_subtree_equals_brute_force(monkeypatch, seed, letters, cut):
    """Nested and overlapping repeats, also inside one segment, in names (which share no words) that batches cut anywhere."""
    rng, window, rows = np.random.default_rng(seed), 4, []
    for name in range(6):
        for doc in range(8):
            n = int(rng.integers(1, 9))
            rows.append((name, doc, 0, 100 * name, n, b" ".join(b"%d.%d" % (name, x) for x in rng.integers(0, letters, n + window - 1))))
        rows.append(rows[-1])  # a row twice is no repeat of itself
    seen, want = {}, set()
    for name, doc, _, start, n, body in rows:
        w = body.split()
        for k in range(n):
            if seen.setdefault(tuple(w[k : k + window]), (doc, start + k)) != (doc, start + k):
                want |= {(doc, start + p) for p in range(k, k + window)}
    monkeypatch.setattr(substring_dedup, "TREE_BYTES", cut)
    schema = pa.schema([(c, pa.int64()) for c in ("name", "doc_id", "tid", "start", "n")] + [("body", pa.binary())])
    batches = [substring_dedup._table(rows[k : k + 5], schema) for k in range(0, len(rows), 5)]
    got = set()
    for made in substring_dedup._subtrees(iter(batches), window):
        for doc, _, start, n in zip(*(c.to_pylist() for c in made.columns)):
            got |= {(doc, p) for p in range(start, start + n + window - 1)}
    assert got == want


def test_near(spark, docs, none):
    rows = [(i, t) for i, t in corpus() if i is not None]
    base = words(200, 3)
    rows += [(1000 + k, " ".join(base[: 200 - k] + words(k, 50 + k))) for k in range(0, 40, 2)]
    rows += [(2000 + k, " ".join(base[:12] + words(k % 2, 90 + k))) for k in range(6)]
    sets = defaultdict(set)
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    frame = spark.createDataFrame([*rows, (None, None), (None, rows[0][1])], "doc_id bigint, text string").withColumn("band", F.lit(1))
    # small blocks: clusters are verified in blocks; few members: wide bands tie without estimates
    for block, most in ((4_000_000, 10_000), (500, 10_000), (500, 1)):
        got = near_dedup.near_components(frame, block_shingles=block, most_members=most).collect()
        assert Counter(tuple(r) for r in got if r.doc_id is not None) == Counter((i, len(sets[i]), root(i), root(i) == i) for i, _ in rows)
        assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2
    assert near_dedup.near_components(none).count() == 0
    assert near_dedup.keep_one(docs).columns == docs.columns


def test_near_large_clusters(spark):
    """One cluster of many blocks that holds several groups, among them sets of very different sizes, against union-find."""
    base, rows = words(400, 30), []
    for g in range(4):
        own = words(60 + 40 * g, 40 + g)
        rows += [(1000 * g + k, " ".join(base[:300] + own[: len(own) - k % 6] + words(k % 6, 900 + k))) for k in range(25)]
    rows += [(9000 + k, " ".join(base[:300] + words(90, 700 + k))) for k in range(12)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    forest = near_dedup.Forest(len(rows))
    names = [i for i, _ in rows]
    for x, a in enumerate(names):
        for y in range(x):
            if 100 * len(sets[a] & sets[names[y]]) >= 85 * len(sets[a] | sets[names[y]]):
                forest.join(x, y)
    want = {i: min(names[y] for y in range(len(names)) if forest.root(y) == forest.root(x)) for x, i in enumerate(names)}
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for block in (1_000, 3_000, 12_000):
        got = {r.doc_id: r.component_id for r in near_dedup.near_components(frame, block_shingles=block, most_members=1).collect()}
        assert got == want


def test_near_repeated_ids(spark):
    """Two texts under one id are one document: what either is linked with shares its component, and goes or stays with it."""
    a, b, c = (" ".join(words(40, 60 + k)) for k in range(3))
    rows = [(5, a), (5, b), (1, a), (9, b), (7, c), (7, c), (8, c), (6, None), (6, a), (None, a)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_components(frame).collect())
    assert got == Counter({(5, 36, 1, False): 2, (1, 36, 1, True): 1, (9, 36, 1, False): 1, (7, 36, 7, True): 2, (8, 36, 7, False): 1, (6, 0, 6, True): 1, (6, 36, 1, False): 1, (None, 36, None, True): 1})
    assert sorted(str(r.doc_id) for r in near_dedup.keep_one(frame).collect()) == ["1", "7", "7", "None"]


@pytest.mark.parametrize("size", [30, 70, 300, 3000])
def test_band_recall(size):
    """Pairs at a similarity just over 0.85, short to long, with sets of equal and unequal size: the share that is tied."""
    rng, tied, pairs = np.random.default_rng(size), 0, 200
    for k in range(pairs):
        pool = near_dedup.mix(rng.integers(0, 1 << 62, 2 * size).astype(np.uint64))
        if k % 2:  # one set within the other
            one, two = pool[:size], pool[: -(-85 * size // 100)]
        else:
            shared = -(-170 * size // 185)
            one, two = pool[:size], np.concatenate([pool[:shared], pool[size : 2 * size - shared]])
        sets = [np.unique(one), np.unique(two)]
        assert 100 * len(np.intersect1d(*sets)) >= 85 * len(np.union1d(*sets))
        regs = near_dedup.registers(sets)
        bands = regs[:, near_dedup._ORDER].reshape(2, near_dedup.BANDS, near_dedup.BAND)
        meets = (bands[0] == bands[1]).all(1).any()
        spread = (0.85 * 0.15 / near_dedup._SMALL) ** 0.5
        ties = near_dedup.band_ties(np.array([1, 2]), regs, np.array([len(x) for x in sets]), 0.85 - 7 * spread)
        tied += bool(meets and ties)
    assert tied >= 0.99 * pairs


def test_spanning_links():
    rng = np.random.default_rng(5)
    for sizes, pool in (((5, 40), 60), ((1, 4), 900), ((90, 100), 104)):  # crowded, sparse, near copies
        sets = [np.sort(rng.choice(pool, rng.integers(*sizes), replace=False)).astype(np.uint64) for _ in range(150)] + [np.zeros(0, np.uint64)]
        true = [(x, y) for x in range(151) for y in range(x) if len(sets[x]) and 100 * len(np.intersect1d(sets[x], sets[y])) >= 85 * len(np.union1d(sets[x], sets[y]))]
        got = near_dedup.spanning_links(sets, 85)
        assert {tuple(sorted(e, reverse=True)) for e in got} <= set(true)
        one, all_ = near_dedup.Forest(151), near_dedup.Forest(151)
        assert all([one.join(*e) for e in got])  # a forest: no link is superfluous
        for e in true:
            all_.join(*e)
        assert [one.root(k) for k in range(151)] == [all_.root(k) for k in range(151)]
    assert near_dedup.spanning_links([], 85) == []


def test_sketch_estimate():
    rng = np.random.default_rng(2)
    pool = near_dedup.mix(rng.integers(0, 1 << 62, 3000).astype(np.uint64))
    sets = [np.unique(pool[:2000]), np.unique(pool[200:2200]), np.unique(pool[2000:])]
    regs = near_dedup.registers(sets)
    chances = near_dedup._chances(np.array([len(s) for s in sets]))
    like = near_dedup.estimate(regs, chances, 0, np.array([1, 2]))
    assert abs(like[0] - 1800 / 2200) < 0.15 and abs(like[1]) < 0.05


def lines_left(rows):
    """What the chunks of all cuts leave of each text whose id has one row, by id."""
    cut, seen, left = {}, {}, {}
    for i, t in sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % line_dedup.MODULUS for x in lines]
        spans = set()
        for c in range(line_dedup.EVERY):
            start = 0
            for e in range(len(h)):
                if e == len(h) - 1 or e > 0 and (h[e - 1] * line_dedup.BASE + h[e]) % line_dedup.MODULUS % line_dedup.EVERY == c:
                    spans.add((start, e + 1))
                    start = e + 1
        cut[i, t] = lines, {(a, b, "\n".join(lines[a:b])) for a, b in spans if b - a > 1 and "".join(lines[a:b]).strip()}
        for a, _, chunk in sorted(cut[i, t][1]):
            seen.setdefault(chunk, (i, a, t))
    for (i, t), (lines, chunks) in cut.items():
        gone = {k for a, b, chunk in chunks if seen[chunk] != (i, a, t) for k in range(a, b)}
        left[i] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return {i: t for i, t in left.items() if len({u for j, u in rows if j == i}) == 1}


def test_lines(docs, none):
    got = line_dedup.dedup_lines(docs)
    assert set(docs.columns) <= set(got.columns)
    for bits in (64, 1):  # one bit: keys collide and places meet by text
        rows = line_dedup.dedup_lines(docs, key_bits=bits).select("doc_id", "n_lines", "n_removed_lines", "text").collect()
        assert len(rows) == len(corpus())
        by = unique([(r.doc_id, r) for r in rows])
        texts = unique(corpus())
        for i, r in by.items():
            t = texts[i]
            assert r.n_lines == (len(t.split("\n")) if t is not None else 0)
            assert (r.text is None) == (t is None)
            if r.n_removed_lines == 0:
                assert r.text == t
        assert sum(r.n_removed_lines for r in rows) > 20
        assert by[63].n_removed_lines > 0  # the shifted copy loses its chunks too
        for i, left in lines_left(corpus()).items():
            if i in by:
                assert by[i].text == left
    assert line_dedup.dedup_lines(none).count() == 0


def test_repeated_pairs(spark, docs, none):
    """The pipeline's stage against brute force: short passages and runs of one line go, whatever their hashes."""
    pipeline = pytest.importorskip("corpus_pipeline")
    shared = [f"shared line {k}" for k in range(3)]
    made = [(i, "\n".join([f"own {i}"] + shared + [f"end {i}"])) for i in range(20)] + [(50, "\n".join(["again"] * 30)), (51, "a\n\n\n\nb"), (None, "x\ny"), (52, "x\ny"), (52, "x\nz"), (53, None), (54, "")]
    for rows in (made, corpus()):
        frame = docs if rows != made else spark.createDataFrame(made, "doc_id bigint, text string")
        seen, want = {}, []
        for i, t in sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
            for k, pair in enumerate(zip(t.split("\n"), t.split("\n")[1:])):
                seen.setdefault(pair, (i, k, t))
        for i, t in rows:
            lines = (t or "").split("\n")
            bad = {k for k in range(len(lines) - 1) if "".join(lines[k : k + 2]).strip() and seen[lines[k], lines[k + 1]] != (i, k, t)}
            want.append((i, t if t is None else "\n".join(x for k, x in enumerate(lines) if not {k, k - 1} & bad)))
        got = [(r.doc_id, r.text) for r in line_dedup.drop_repeated_pairs(frame).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert line_dedup.drop_repeated_pairs(none).count() == 0
    frame = spark.createDataFrame([(i, t, len(t or "")) for i, t in made], "doc_id bigint, text string, n_chars bigint")
    left = {r.doc_id: r for r in pipeline.line_deduplication(spark, frame, "").collect()}
    assert all(left[i].text == f"own {i}\nend {i}" and left[i].n_chars == len(left[i].text) for i in range(1, 20)) and left[50].text == "again"


def test_licences(docs, none):
    assert license_scan.licence_report(docs).count() == len(corpus())
    assert license_scan.licence_report(none).count() == 0
    text = "Text. Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License.\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS basis.\nAll rights reserved."
    row = license_scan.licence_report(docs.sparkSession.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row.n_sentences, row.licences, row.categories, row.restricted) == (5, "Apache-2.0,Proprietary", "permissive,restricted", True)


def test_licence_gaps(spark):
    """A rule's sentences stand next to each other: others between them part them, the fillers of a notice do not."""
    rows = [
        (1, "Copyright 2020 Jane.\nAll rights reserved.", "copyright,all-rights-reserved", 1),
        (2, "Permission is hereby granted, free of charge, to any person obtaining a copy.\nThe above copyright notice and this permission notice shall be included in all copies.\nThe software is provided as is, without warranty of any kind.", "mit-permission,mit-asis", 1),
        (3, "Licensed under the Apache License, Version 2.0.\nSomething else.\nYou may not use this file except in compliance with the License.", "apache-2.0-grant,apache-2.0-use", 1),
    ]
    got = {r.doc_id: r for r in license_scan.scan_licences(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")).collect()}
    assert all(",".join(got[i].sentence_ids) == ids and len(got[i].licences) == n for i, _, ids, n in rows)
    apart = [(4, "Copyright 2020 Jane.\nShe sells shells.\nThey are nice.\nAll rights reserved."), (5, "Copyright 2020 Jane.\n\n  \nAll rights reserved.")]
    used = license_scan.RULES
    try:
        license_scan.RULES = (("Both", "restricted", ("copyright", "all-rights-reserved")),)
        found = {r.doc_id: r.licences for r in license_scan.scan_licences(spark.createDataFrame(apart, "doc_id bigint, text string")).collect()}
    finally:
        license_scan.RULES = used
    assert found == {4: [], 5: ["Both"]}


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """Copyright (c) 2020 Some One

Permission is hereby granted, free of
charge, to any person obtaining a copy of this software, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
ANY KIND, EXPRESS OR IMPLIED."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
CC = """This work is licensed under a Creative Commons Attribution{} 4.0 International
License. To view a copy of this license, visit http://creativecommons.org/licenses/."""
CC0 = """To the extent possible under law, Some One has waived all copyright and
related or neighboring rights to This Work."""


NOTICES = [
    (APACHE, "Apache-2.0"), (MIT, "MIT"), (GPL3, "GPL"), (GPL3.replace("software:", "software;"), "GPL"), (LGPL, "LGPL"), (MPL, "MPL-2.0"), (BSD, "BSD"),
    (CC.format(""), "CC-BY-4.0"), (CC.format("-NonCommercial"), "CC-BY-NC-4.0"), (CC.format("-ShareAlike"), "CC-BY-SA-4.0"), (CC.format("-NoDerivatives"), ""), (CC0, "CC0-1.0"),
    ("SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("All rights\nreserved.", "Proprietary"),
    ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", "AGPL-3.0"), ("SPDX-License-Identifier: ISC", "ISC"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("The MIT License (MIT)", "MIT"), ("BSD 3-Clause License", "BSD-3-Clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.", "ISC"), ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("It is not licensed under the\nMIT License.", ""), ("He spoke as is\nhis habit with permission", ""),
]


def test_published_licences(spark):
    """Each notice wrapped, in comments of two kinds, and on one line."""
    rows = []
    for text, names in NOTICES:
        flat = text.replace("\n\n", "\0").replace("\n", " ").replace("\0", "\n\n")
        for way in (text, "\n".join(f"# {x}" for x in text.split("\n")), "\r\n".join(f" * {x}" for x in text.split("\n")), f"Some words.\n\n{flat}"):
            rows.append((len(rows), way, names))
    got = license_scan.licence_report(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").coalesce(1)).collect()
    by = {r.doc_id: r for r in got}
    assert [(way, by[i].licences) for i, way, _ in rows] == [(way, names) for _, way, names in rows]
    assert {by[i].sentence_ids for i in range(4)} == {"apache-2.0-grant,apache-2.0-use,apache-2.0-asis"}


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_scores(spark, docs, none, score):
    got = score(docs, labels(spark)).collect()
    assert len(got) == len(corpus()) and all(0 <= r.score <= 1 for r in got)
    mod, rest = (4, 2) if score is quality.quality_scores else (5, 0)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % mod == rest) for r in got)
    assert score(none, labels(spark)).count() == 0
    assert score(docs, labels(spark).limit(0)).count() == len(corpus())


def test_keep_good_trains_like_the_scores(spark):
    """Null labels take no place in the bounded sample; documents of equal ids and labels are kept alike."""
    rows = [(i, " ".join(words(30, i)) if i % 2 else "z " * (20 + i % 9)) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, i % 2 if i % 10 < 5 else None) for i, _ in rows] + [(None, 1)], "doc_id bigint, quality int")
    want = {r.doc_id for r in quality.quality_scores(frame, marks, most_rows=60).where("score >= 0.5").collect()}
    got = {r.doc_id for r in quality.keep_good(frame, marks, most_rows=60).collect()}
    assert got == want and 100 < len(got) < 200


def test_trees_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_trees(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) > 0.5) == y[1500:]).mean() > 0.93


def sparse(vectors):
    rows = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
    return rows, np.concatenate([t for t, _ in vectors]), np.concatenate([c for _, c in vectors]).astype(float)


@pytest.mark.parametrize("block, pool", [(16, 300), (7, 40), (64, 2000)])
def test_nearest_is_exact(block, pool):
    """All neighbours of every query, in order, ties by example, against dense cosines; also with one left out."""
    rng = np.random.default_rng(4)
    vectors = [(np.sort(rng.choice(pool, rng.integers(1, 30), replace=False)), rng.integers(1, 5, 30)) for _ in range(400)]
    vectors = [(t, c[: len(t)]) for t, c in vectors]
    vectors += vectors[:30] + [(np.zeros(0, np.int64), np.zeros(0, np.int64))]  # ties, and an example without terms
    weight = rng.uniform(0.01, 3, pool) ** 2
    rows, terms, counts = sparse(vectors)
    index = toxicity.build_index(np.arange(len(vectors)), np.arange(len(vectors)) % 2, rows, terms, counts, weight, 1.0, 10, block=block)
    assert len(index.ids) == len(vectors) - 1
    dense = np.zeros((len(index.ids), pool))
    for e, i in enumerate(index.ids):
        t, c = vectors[i]
        dense[e, t] = (1 + np.log(c)) * weight[t]
    dense /= np.sqrt((dense**2).sum(1))[:, None]
    n = len(vectors)
    place = np.array([int(np.flatnonzero(index.ids == i)[0]) if i in index.ids else -1 for i in range(n)])
    for skip in (None, place):
        r, e, s = index.nearest(rows, terms, index.vectors(rows, terms, counts, n), n, 10, skip)
        for i in range(n):
            if not len(vectors[i][0]):
                assert not (r == i).any()
                continue
            like = dense @ dense[place[i]]
            if skip is not None:
                like[place[i]] = 0
            want = np.sort(like[like > 1e-12])[::-1][:10]
            got = s[r == i]
            assert len(got) == len(want) and np.allclose(got, want)
            assert np.allclose(like[e[r == i]], got) and len(set(e[r == i].tolist())) == len(want)


def test_toxicity_equals_brute_force(spark):
    """Scores, votes and evidence of 300 documents against a plain computation over all terms of the sample."""
    rng = np.random.default_rng(8)
    pool = words(400, 77)
    texts = [" ".join(pool[j] for j in rng.integers(0, 400, rng.integers(3, 60))) for _ in range(300)]
    bad = set(range(0, 300, 4))
    texts = [t + (" nasty foul" if i in bad and i % 8 else "") for i, t in enumerate(texts)]
    texts[20], texts[21], texts[22] = "", None, texts[40]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    marks = spark.createDataFrame([(i, int(i in bad)) for i in range(300)], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_scores(frame, marks, k=7).collect()}

    def terms(text):
        out = Counter()
        for w in re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().lower()):
            out[w] += 1
            if len(w) > toxicity.HEAD:
                out[0, w[: toxicity.HEAD]] += 1
        return out

    train = {}
    for i in range(300):
        if zlib.crc32(str(i).encode()) % 5:
            slot = train.setdefault(texts[i] or "", [i, 0])
            slot[1] = max(slot[1], int(i in bad))
    rows = sorted((i, y, terms(t)) for t, (i, y) in train.items())
    ids_of = [sum(1 for i in range(300) if zlib.crc32(str(i).encode()) % 5 and (i in bad) == flag) for flag in (False, True)]
    n1 = sum(y for _, y, _ in rows)
    n0 = len(rows) - n1
    has, yes, df = Counter(), Counter(), Counter()
    for _, y, t in rows:
        has.update(t.keys())
        yes.update(t.keys() if y else ())
    for t in texts:
        df.update(terms(t).keys())
    weight = {w: (np.log(301 / (1 + df[w])) + 1) * (toxicity.FLOOR + abs(np.log(((yes[w] + 1) / (n1 + 2)) / ((has[w] - yes[w] + 1) / (n0 + 2))))) for w in has}

    def unit(t):
        v = {w: (1 + np.log(c)) * weight[w] for w, c in t.items() if w in weight}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    examples = [(i, y, unit(t)) for i, y, t in rows if t]
    odds = (ids_of[0] / n0) / (ids_of[1] / n1)
    for i, t in enumerate(texts):
        q = unit(terms(t))
        like = sorted(((sum(x * e.get(w, 0) for w, x in q.items()), j, y) for j, y, e in examples), reverse=True)[:7] if q else []
        assert len(got[i].evidence) == len([s for s, _, _ in like if s > 1e-12])
        by = {j: s for s, j, _ in like}
        kth = like[-1][0] if like else 0
        assert all(by.get(j, kth) == pytest.approx(kth) or j in by for j in got[i].evidence)
        assert got[i].predicted == int(got[i].score >= 0.5)
    x, y = [], []
    for i, t in enumerate(texts):
        q = unit(terms(t))
        if q:
            like = sorted(((sum(v * e.get(w, 0) for w, v in q.items()), y_) for _, y_, e in examples), reverse=True)[:7]
            up, down = sum(s * s for s, y_ in like if y_), odds * sum(s * s for s, y_ in like if not y_)
            x.append(np.log((up + 0.02) / (down + 0.02 * odds)))
            y.append(np.log(got[i].score / (1 - got[i].score)))
    a, b = np.polyfit(x, y, 1)  # the calibration is a line in log-odds
    assert np.abs(np.array(y) - (a * np.array(x) + b)).max() < 1e-6 and a > 0
    assert got[20].score == got[21].score and got[20].evidence == []


def test_pipeline_near_from_80(spark):
    """Two documents with 41 of 50 shingles in common (0.82) are one to the pipeline, two to op10's 0.85."""
    pipeline = pytest.importorskip("corpus_pipeline")
    base = words(49, 5)
    frame = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[:45] + words(4, 6)))], "doc_id bigint, text string")
    shingles = [{tuple(r.text.split()[i : i + 5]) for i in range(45)} for r in frame.orderBy("doc_id").collect()]
    assert 0.8 <= len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1]) < 0.85
    assert near_dedup.keep_one(frame).count() == 2
    assert pipeline.near_deduplication(spark, frame, "").count() == 1


def test_pipeline_keeps_what_quality_predicts(spark, tmp_path):
    """Labels that no text explains give scores about their share, 0.6: op7 predicts 0 there, so they go."""
    pipeline = pytest.importorskip("corpus_pipeline")
    frame = spark.createDataFrame([(i, " ".join(words(30, i))) for i in range(300)], "doc_id bigint, text string")
    spark.createDataFrame([(i, int(i % 5 < 3)) for i in range(300)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    scores = quality.quality_scores(frame, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()
    assert any(0.5 <= r.score < 0.7 for r in scores)
    got = {r.doc_id for r in pipeline.quality_classifier(spark, frame, str(tmp_path)).collect()}
    assert got == {r.doc_id for r in scores if r.predicted == 1}


def test_pipeline_stages(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    before = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "packing"]
    kept = before
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, kept, sf)
        assert after.columns == before.columns
        after.write.parquet(str(tmp_path / _.replace(" ", "-")))
        after = spark.read.parquet(str(tmp_path / _.replace(" ", "-")))
        assert after.join(kept, "doc_id", "left_anti").count() == 0 and 0 < after.count() <= kept.count()
        kept = after
    assert kept.count() > 0.7 * before.count()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontamination.contamination_report(kept, bench).where("contaminated").count() == 0
    assert near_dedup.near_components(kept).where("NOT kept").count() == 0
    pieces = packing.pack(kept)
    assert pieces.select("doc_id").distinct().count() == kept.count()


def test_line_stage_drops_chunks_then_pairs(spark):
    """Blanks within a repeated chunk are no pairs, so chunks alone name them; passages that chunks cut are the pairs'."""
    rows = [(0, None), (1, "")]
    for k in range(12):
        passage = "\n".join([f"w{k} alpha", *[f"m{k}{j}" for j in range(3)], *[""] * 5, *[f"n{k}{j} b" for j in range(4)]])
        rows += [(10 * k + 11, f"top{k}\n{passage}\nend{k}"), (10 * k + 12, f"lead{k}\n{passage}\nlast{k}"), (10 * k + 13, f"x\nw{k} alpha\nm{k}0\ny{k}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    chunked = {(r.doc_id, r.start + i) for r in line_dedup._later_chunks(line_dedup._chunks(texts)).collect() for i in range(r.n)}
    paired = {(r.doc_id, r.start + i) for r in line_dedup._later_pairs(texts).collect() for i in range(r.n)}
    want = {}
    for r in docs.collect():
        lines = None if r.text is None else r.text.split("\n")
        gone = {i for d, i in chunked | paired if d == r.doc_id}
        want[r.doc_id] = (r.text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    assert chunked - paired and paired - chunked
    assert {r.doc_id: (r.text, r.n_removed_lines) for r in line_dedup.drop_repeats(docs).collect()} == want


def test_pipeline_line_stage_runs_the_chunks(spark, monkeypatch):
    seen = []
    cut = line_dedup._chunks
    monkeypatch.setattr(line_dedup, "_chunks", lambda texts: seen.append(1) or cut(texts))
    pipeline = pytest.importorskip("corpus_pipeline")
    pipeline.line_deduplication(spark, spark.createDataFrame([(1, "a\nb\nc"), (2, "a\nb\nc")], "doc_id bigint, text string"), "").collect()
    assert seen
