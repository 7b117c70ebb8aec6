"""The operators with Arrow functions, against plain Python."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from llm_fixtures import corpus, frame, line, odd
from pyspark.sql import functions as F

from ingestry.llm import bpe, components, decontaminate, simhash, substrings, toxicity

VOCAB = pytest.importorskip("public_tokenizers")
PATH, PATTERN = VOCAB.path("byte_bpe_50k.tiktoken"), VOCAB.PATTERN


def python_print(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    grams = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def python_groups(prints, reach=3):
    """[(id, print)] -> [smallest id of each one's component]."""
    n = len(prints)
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= reach:
                root[top(i)] = top(j)
    least = {}
    for i, (k, _) in enumerate(prints):
        if k is not None:
            least[top(i)] = min(k, least.get(top(i), k))
    return [least.get(top(i)) for i in range(n)]


def test_simhash(spark):
    rows = corpus()
    prints = [(k, python_print(t)) for k, t in rows]
    want = {k: (f"{p:016x}", c) for (k, p), c in zip(prints, python_groups(prints))}
    for leaf, block in ((4, 16_384), (simhash.LEAF, simhash.BLOCK)):
        got = simhash.near_duplicates(frame(spark, rows), leaf=leaf, block=block)
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in got.collect()} == want
    found = simhash.near_duplicates(odd(spark)).collect()
    assert len(found) == 6 and {r.component_id for r in found if r.doc_id in (4, 5)} == {4}
    assert simhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_links_in_small_leaves_and_blocks(spark):
    """Chains and a dense ball, in leaves so small that most pairs cross a boundary."""
    rng = random.Random(3)
    points = {rng.getrandbits(64) for _ in range(300)}
    for p in list(points)[:40]:
        for _ in range(6):
            p ^= sum(1 << b for b in rng.sample(range(64), 3))
            points.add(p)
    centre = rng.getrandbits(64)
    points |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}
    points = sorted(points)
    want = python_groups(list(enumerate(points)))
    fps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fp long")
    for leaf, block in ((8, 4096), (64, 50)):
        root = {r.node: r.root for r in components.components(simhash.links(fps, leaf=leaf, block=block)).collect()}
        signed = [p - (1 << 64) if p >> 63 else p for p in points]
        groups = {}
        for p, w in zip(signed, want):
            groups.setdefault(w, set()).add(root.get(p, p))
        assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_tree_prunes(spark):
    points = np.random.default_rng(0).integers(0, 1 << 63, 4096, dtype=np.uint64)
    nodes = simhash.fit_tree(points, 4096, 256)
    leaves = simhash.route(nodes, points, 3)
    assert sum(len(h) for _, h, _ in leaves) == 4096 and len(leaves) >= 16
    assert sum(len(h) * (len(h) + len(g)) for _, h, g in leaves) < 4096**2 / 2


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 41)} | {101: 100}
    assert components.components(edges.limit(0)).count() == 0


def python_cut(rows, length, keep):
    seen, count = set(), {}
    texts = [(k, (t or "").encode()) for k, t in rows]
    for _, b in texts:
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = {}
    for k, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if count[s] > 1 if keep == "none" else s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
        out[k] = (len(b), bytes(c for c, g in zip(b, gone) if not g), spans)
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("length, contexts", [(400, 6000), (64, 6000), (64, 2)])
def test_substring_dedup(spark, keep, length, contexts):
    rows = corpus()
    got = substrings.dedup(frame(spark, rows), length=length, keep=keep, max_contexts=contexts)
    found = {r.doc_id: (r.n_bytes, bytes(r.kept), [tuple(s) for s in r.removed]) for r in got.collect()}
    assert found == python_cut(rows, length, keep)


def test_substring_dedup_odd_rows(spark):
    text = "z y x w v u " * 60
    twice = [(None, text), (1, text), (1, text), (2, None)]
    kept = {k: [r.kept for r in substrings.dedup(frame(spark, twice), keep=k).collect()] for k in ("none", "first")}
    assert sorted(map(len, kept["none"])) == [0, 0, 0, 0]
    # a null id sorts first; the two rows of id 1 are one document, a later copy
    assert sorted(map(len, kept["first"])) == sorted([0, 0, 0, len(python_cut([(0, text)], 400, "first")[0][1])])
    assert substrings.dedup(odd(spark)).count() == 6
    assert substrings.dedup(frame(spark, []).limit(0)).count() == 0


def test_anchors_across_pieces(monkeypatch):
    rng = random.Random(1)
    text = "".join(line(rng, 50) for _ in range(40)).encode()
    whole = substrings.anchors(text)
    monkeypatch.setattr(substrings, "PIECE", 700)
    assert (substrings.anchors(text) == whole).all()


def tiktoken_coder():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(spark):
    coder = tiktoken_coder()
    every = "".join(chr(c) for c in range(1, 0x3000)) + "".join(chr(c) for c in range(0x1F300, 0x1F700))
    rows = corpus() + [(900, every), (901, "a" * 30_000), (902, "I'll we've 12345 東京 <|endoftext|> \n\n  x   y\t "), (903, " " * 5000)]
    docs = frame(spark, rows)
    got = bpe.encode_decode(docs, PATH, PATTERN)
    found = {r.doc_id: r for r in got.collect()}
    for k, t in rows:
        assert list(found[k].ids) == coder.encode_ordinary(t or "") and bytes(found[k].decoded) == (t or "").encode()
    back = bpe.decode(got.select("doc_id", "ids"), PATH, PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded) for r in back} == {k: (t or "").encode() for k, t in rows}
    assert bpe.encode_decode(odd(spark), PATH, PATTERN).count() == 6
    assert bpe.encode_decode(docs.limit(0), PATH, PATTERN).count() == 0


def test_minimal_hash_is_minimal_and_perfect():
    keys = [str(k).encode() for k in range(5000)] + [b""]
    found = bpe.MinimalHash(keys)
    assert sorted(found.keys) == list(range(len(keys)))
    assert [found.find(k) for k in keys] == list(range(len(keys)))


def test_resolved_pretokens_come_back_from_the_older_half():
    asked = []
    ids = bpe.Resolved(lambda t: asked.append(t) or t.encode(), limit=3)
    words = ["a", "b", "c", "d", "a", "x" * 1000, "x" * 1000, "e", "f", "a"]
    assert [ids[w] for w in words] == [w.encode() for w in words]
    assert asked == ["a", "b", "c", "d", "x" * 1000, "x" * 1000, "e", "f"] and len(ids) <= 3


def bench_items(rng, n=30):
    return [(k, "\n".join(line(rng, rng.randint(5, 25)) for _ in range(1 + k % 3))) for k in range(n)]


def python_scores(passage, items):
    """BM25 impacts over the words of the passage, as shares of the item's own score."""
    texts = [decontaminate.words_of(t) for _, t in items]
    mean = sum(map(len, texts)) / len(texts)
    df = {w: sum(w in set(t) for t in texts) for t in texts for w in t}
    out = []
    for t in texts:
        own = {
            w: np.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5)) * t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / mean))
            for w in set(t)
        }
        out.append(sum(x for w, x in own.items() if w in passage) / sum(own.values()))
    return out


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(2)
    items = bench_items(rng, 60)
    texts = [decontaminate.words_of(t) for _, t in items]
    df = {w: sum(w in set(t) for t in texts) for t in texts for w in t}
    index = decontaminate.Index(items, len(items), sum(map(len, texts)) / len(texts), df)
    for k in range(30):
        passage = set(rng.sample(sorted(df), 18)) | set(texts[k][: 1 + k])
        want = {i: s for i, s in enumerate(python_scores(passage, items)) if s >= 0.5}
        got = dict(index.search([index.terms[w] for w in passage], 0.5, list(range(index.n_blocks))))
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)


@pytest.mark.parametrize("shard", [16_000_000, 700])
def test_decontamination(spark, shard):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(4000)]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, f"{some(20)}.\n{some(6)}." if k % 2 else f"{some(15)}.") for k in range(25)]
    docs, want = [(k, some(rng.randint(0, 400))) for k in range(40)], set()
    for k in range(0, 20):
        text = docs[k][1].split(" ")
        at = rng.randint(0, len(text))
        docs[k] = (k, " ".join(text[:at]) + " " + items[k][1].upper().replace("\n", " - ") + " " + " ".join(text[at:]))
        want.add((k, k))
    docs += [(50, items[21][1].split("\n")[0]), (51, None), (52, "")]  # a question without its answer
    docs += [(53, (some(3000) + " " + items[22][1]))]
    want.add((53, 22))
    bench = spark.createDataFrame(items + [(98, None), (99, "...")], "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, docs), bench, index_bytes=shard).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and all(r.score > 0.99 for r in got)
    assert decontaminate.contaminated(odd(spark), bench).count() == 0
    assert decontaminate.contaminated(odd(spark), bench.limit(0)).count() == 0
    assert decontaminate.contaminated(frame(spark, docs).limit(0), bench).count() == 0


def test_toxicity(spark):
    rng = random.Random(6)
    insults = ["dolt", "oafish", "wretch"]
    docs, labels = [], []
    for k in range(600):
        ws = line(rng, rng.randint(20, 60)).split(" ")
        bad = k % 5 in (0, 2)
        if bad:
            for _ in range(4):
                ws.insert(rng.randrange(len(ws)), rng.choice(insults) if k % 3 else "grml" + rng.choice("abcdef") * 2)
        docs.append((k, " ".join(ws)))
        labels.append((k, int(bad)))
    docs += [(900, None), (901, ""), (902, "word " * 30_000)]
    known = spark.createDataFrame(labels + [(0, None), (5, 1), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(frame(spark, docs), known).collect()}
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    held = [(got[k].predicted, y) for k, y in labels if got[k].held_out]
    assert len(held) > 80 and sum(p == y for p, y in held) / len(held) > 0.95
    assert got[901].predicted == 0
    one = toxicity.score(odd(spark), known.filter("toxic = 1"))
    assert one.count() == 6 and one.filter("held_out is null or score is null").count() == 0
    assert toxicity.score(odd(spark), known.limit(0)).agg(F.max("score")).first()[0] == 0.0


def test_toxicity_of_rare_labels(spark):
    """Half a percent is toxic, and the bound on training rows is far below the input."""
    rng = random.Random(9)
    docs, toxic = [], set(rng.sample(range(6000), 30))
    for k in range(6000):
        ws = line(rng, rng.randint(15, 25)).split(" ")
        if k in toxic:
            ws[3:3] = ["you", "dolt", "wretch", "dolt"]
        docs.append((k, " ".join(ws)))
    known = spark.createDataFrame([(k, int(k in toxic)) for k, _ in docs], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.score(frame(spark, docs, clash=False), known, train_rows=200).collect()}
    found = {k for k, p in got.items() if p}
    assert len(found & toxic) >= 28 and len(found - toxic) <= 3


def test_label_draw(spark):
    known = spark.range(50_000).selectExpr("id AS _id", "CAST(id % 1000 = 0 AS INT) AS label")
    drawn = {r.label: r for r in toxicity._drawn(known, 2000, 40).groupBy("label").agg(F.count("*").alias("n"), F.max("weight").alias("w")).collect()}
    assert 25 <= drawn[1].n <= 50 and 1700 <= drawn[0].n <= 2300  # about 40 of 50, not 2
    assert abs(drawn[1].w * 40 - 50) < 1e-9 and abs(drawn[0].w * 1998 - 49_950) < 1e-6
    assert toxicity._drawn(known, 100_000).count() == 50_000
    even = toxicity._drawn(known.selectExpr("_id", "CAST(_id % 4 = 0 AS INT) AS label"), 8000, 100)
    assert even.filter("weight != 1").count() == 0 and 7400 < even.count() < 8600


def test_obfuscation_and_proximity():
    marker = toxicity.Marker({"=dolt": 3.0, "^grml": 2.0})
    at = {f: k for k, f in enumerate(toxicity.FEATURES)}
    plain, near = marker.features("quite a dolt here grmlxy"), marker.features("you are a dolt")
    assert plain[at["word_density"]] == plain[at["prefix_density"]] == 0.2 and plain[at["near_share"]] == 0
    assert near[at["near_share"]] == 1 and marker.features("d0lt doooolt")[at["obfuscated_hits"]] > 0
    assert marker.features("") == [0.0] * len(toxicity.FEATURES)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from test_native_ops import python_dedup, python_quality

    rng = random.Random(8)
    items = [(k, line(rng, 40)) for k in range(4)]
    rows = corpus()
    rows += [(200, rows[5][1] + "\n" + items[1][1] + "\n" + line(rng, 40)), (201, rows[7][1] + " and " + items[2][1] + " more")]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = {k: python_quality(t)[-1] for k, t in rows if python_quality(t)[-2]}
    docs = {k: t for k, t in python_dedup(sorted(docs.items())).items() if t}
    prints = sorted((k, python_print(t)) for k, t in docs.items())
    docs = {k: docs[k] for (k, _), c in zip(prints, python_groups(prints)) if c == k}
    has = lambda t: any(" ".join(decontaminate.words_of(i)) in " ".join(decontaminate.words_of(t)) for _, i in items)
    docs = {k: t for k, t in docs.items() if not has(t)}
    coder = tiktoken_coder()
    want = {k: (coder.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for k, t in docs.items()}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (list(r.ids), r.decoded_sha256) for r in got} == want
    assert all(r.n_tokens == len(r.ids) for r in got) and 200 not in want and 0 < len(want) < len(rows)
    step = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, step, str(tmp_path))
        assert out.columns == step.columns and stage(spark, step.limit(0), str(tmp_path)).count() == 0
        stage(spark, odd(spark), str(tmp_path)).count()


def test_pipeline_rows_without_ids_and_repeated_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    leak, clean, other = (line(rng, 60) for _ in range(3))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, clean), (None, f"{other} {leak}"), (None, other), (7, clean), (7, clean), (8, other), (8, line(rng, 70))]
    docs = frame(spark, rows)
    kept = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(k), t) for k, t in rows if leak not in t)
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("7", clean), ("8", other), ("None", rows[1][1]), ("8", rows[6][1])])


@pytest.mark.parametrize("name", [f"op{k}" for k in range(1, 11)] + ["pipeline"])
def test_registered(name):
    import __spark_entry__

    assert sum(q == name or q.startswith(name + "_") for q in __spark_entry__.queries()) == 1


def test_longest_factors():
    """LPF and its mirror image against all pairs, within the contexts' ends and capped."""
    rng = random.Random(8)
    for length in (8, 24, 40):
        for _ in range(25):
            parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 2 * length))) for _ in range(rng.randint(1, 6))]
            parts += rng.sample(parts, rng.randint(0, len(parts)))
            text = b"".join(parts)
            ends = np.cumsum([len(p) for p in parts])
            left = np.concatenate([e - np.arange(e - len(p), e) for p, e in zip(parts, ends)])
            levels = substrings.suffix_ranks(text, left, length)
            starts = np.flatnonzero(left >= length)
            order = starts[np.argsort(levels[-1][1][starts], kind="stable")]
            shared = substrings.neighbour_prefixes(text, order, levels, length)

            def common(i, j):
                n = 0
                while n < length and text[i + n] == text[j + n]:
                    n += 1
                return n

            assert shared.tolist() == [common(a, b) for a, b in zip(order, order[1:])]
            for previous in (True, False):
                got = dict(zip(order.tolist(), substrings.longest_factors(order, shared, previous=previous).tolist()))
                for i in starts.tolist():
                    others = [j for j in starts.tolist() if (j < i if previous else j > i)]
                    assert got[i] == max((common(i, j) for j in others), default=0)


def test_sieve(spark):
    from ingestry.llm.common import sieve, sifted

    rows = spark.range(5000).selectExpr("id", "id * 7 AS k")
    passed, rest = sifted(rows, sieve(rows.filter("id % 10 = 3"), "k"), "k")
    passed, rest = {r.id for r in passed.collect()}, {r.id for r in rest.collect()}
    assert {n for n in range(5000) if n % 10 == 3} <= passed and not passed & rest and len(passed | rest) == 5000
    assert len(passed) < 520
    assert sifted(rows, sieve(rows.limit(0), "k"), "k")[0].count() == 0


def test_substring_dedup_registered(spark):
    from ingestry.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = python_cut(rows, 400, "none")
    for r in QUERIES["op2_suffix_array_dedup"](spark, sf).collect():
        n, kept, spans = want.pop(r.doc_id)
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, n - len(kept), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert not want
