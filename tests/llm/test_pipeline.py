"""The pipeline's stages against brute force."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from tiktoken.load import load_tiktoken_bpe

from marquee.llm import decontaminate, quality, shingles, simhash
from marquee.session import materialise

RNG = random.Random(5)


def shingle_set(text, n=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def groups_of(texts, least=0.8):
    """Place of the first text of each text's component."""
    sets, root = [shingle_set(t) for t in texts], {}
    for i in range(len(texts)):
        if i not in root:
            stack, root[i] = [i], i
            while stack:
                here = stack.pop()
                for j in range(len(texts)):
                    if j not in root and jaccard(sets[here], sets[j]) >= least:
                        root[j] = i
                        stack.append(j)
    return root


def near_copies():
    """Texts with planted copies from well above to well below the limit, and chains of them."""
    out = []
    for n in (12, 40, 120, 300):
        for _ in range(6):
            base = [f"w{RNG.randrange(500)}" for _ in range(n)]
            out.append(" ".join(base))
            for share in (0.005, 0.01, 0.02, 0.03, 0.04, 0.06):
                words = [f"v{RNG.randrange(500)}" if RNG.random() < share else w for w in base]
                out.append("  ".join(words).upper())
    return out + [None, "", " \n", "one", "ONE", "one two", "Ä b c d e f g h i j", "ä b c d e f g h i j"]


@pytest.mark.parametrize("block, block_bytes", [(2, 1 << 20), (2048, 300), (2048, 8 << 20)])
def test_all_similar_texts_are_grouped(spark, block, block_bytes):
    texts = near_copies()
    df = spark.createDataFrame(list(enumerate(texts)), "at long, text string").repartition(6)
    got = {r.id_: r.root for r in shingles.similar_groups(df, "at", block=block, block_bytes=block_bytes).collect()}
    want = groups_of(texts)
    assert len(got) == len(texts) and len(set(want.values())) < len(texts) - 30
    # The same partition: each brute-force group has one root of its own.
    assert len(set(got.values())) == len({(got[i], want[i]) for i in got}) == len(set(want.values()))
    assert shingles.similar_groups(df.limit(0), "at").count() == 0


def test_near_copies_are_dropped(spark):
    texts = near_copies()
    rows = [(None if i % 11 == 0 else 1000 - i, t, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id_ int").repartition(4)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    want, best = groups_of(texts), {}
    for i, r in enumerate(rows):
        best.setdefault(want[i], []).append((r[0] is None, r[0] or 0))
    assert sorted(r.doc_id or 0 for r in kept) == sorted(min(v)[1] for v in best.values())
    assert kept[0].__fields__ == ["doc_id", "text", "id_"]


# --- the whole pipeline -------------------------------------------------------------------

WORDS = "river stone bright window garden paper morning little answer market winter travel music simple letter".split()
SCHEMA = "doc_id long, text string, row_number_ int, kept_ string, stats_ int"


def prose(n):
    words = [RNG.choice(WORDS) + RNG.choice(["", "", "s", "ed"]) + str(RNG.randrange(9)) * (RNG.random() < 0.2) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def junk():
    return " ".join(RNG.choice(["$$$", "!!!!", "#click#", "WIN", "0000", "||||"]) for _ in range(30))


def edits_in(item, text):
    """Least edit distance of the item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Folder and rows: prose and junk, copies, near copies, benchmark passages, nulls, repeats, columns with taken names."""
    passages = [prose(20) for _ in range(4)]
    texts = [prose(40) for _ in range(50)] + [junk() for _ in range(25)]
    rows = [(i, t, i, "kept", 0) for i, t in enumerate(texts)]
    labels = [(i, int(i < 50)) for i in range(75)] + [(None, 1), (3, None), (60, 0)]
    base = prose(150)
    rows += [(200 + i, texts[i % 3].upper() if i % 2 else texts[i % 3], None, None, None) for i in range(9)]
    rows += [(300 + i, base.replace(" ", "  ", i) + f" tail{i}", 1, "k", 1) for i in range(4)]
    rows += [(400 + i, prose(15) + " " + p.replace("e", "x", 1) + " " + prose(15), 1, "k", 1) for i, p in enumerate(passages)]
    rows += [(None, base, 1, "k", 1), (None, prose(40), 1, "k", 1), (500, None, 1, "k", 1), (501, "", 1, "k", 1), (None, None, 1, "k", 1)]
    rows += [(600, texts[7], 1, "k", 1)] * 2 + [(7, texts[7], 7, "kept", 0)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    items = [*enumerate(passages), (None, texts[0]), (9, None), (10, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, passages


def brute_exact(rows):
    best = {}
    for r in rows:
        k = lowered(r[1])
        if k not in best or (r[0] is not None and (best[k][0] is None or r[0] > best[k][0])):
            best[k] = r
    return list(best.values())


def brute_near(rows):
    root, best = groups_of([r[1] for r in rows]), {}
    for i, r in enumerate(rows):
        old = best.get(root[i])
        if old is None or (r[0] is None, r[0] or 0) < (old[0] is None, old[0] or 0):
            best[root[i]] = r
    return list(best.values())


def brute_clean(rows, passages):
    items = [decontaminate.normal(p) for p in passages]
    return [r for r in rows
            if not any(edits_in(i, decontaminate.normal(r[1])) <= decontaminate.budget(len(i)) for i in items)]


def brute_tokens(rows):
    library = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    out = []
    for r in rows:
        ids = library.encode_ordinary(r[1] or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (r[1] or "").encode())]
        out.append((r[0], len(ids), *digests))
    return out


def bag(rows):
    """Rows as a multiset; equal texts that differ in case only may stand for one another."""
    return Counter((r[0], lowered(r[1])) for r in rows)


def test_every_stage_and_the_run_equal_brute_force(spark, corpus):
    folder, rows, passages = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = quality.quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet"), carry=docs.columns)
    want = [tuple(r)[:5] for r in scored.where("predicted = 1").collect()]
    junk_ids = set(range(50, 75))
    assert not junk_ids & {r[0] for r in want} and {r[0] for r in want} >= set(range(50))
    left = docs
    for (name, stage), brute in zip(corpus_pipeline.STAGES[:-1], (
            lambda _: want, brute_exact, brute_near, lambda x: brute_clean(x, passages)), strict=True):
        expected = brute([tuple(r) for r in left.collect()])
        left = materialise(stage(spark, left, folder), "stage-test")
        assert left.columns == docs.columns, name
        assert bag(left.collect()) == bag(expected), name
    # What was planted: three exact groups, one near group, all passages.
    ids = [r.doc_id for r in left.collect()]
    assert not {400, 401, 402, 403} & set(ids) and len({300, 301, 302, 303} & set(ids)) == 1
    tokens = Counter(map(tuple, corpus_pipeline.count_tokens(spark, left, folder).collect()))
    assert tokens == Counter(brute_tokens([tuple(r) for r in left.collect()]))
    whole = Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, folder).collect())
    assert sum(whole.values()) == len(ids) and set(whole) == {(r[0], r[1]) for r in tokens}


def test_stages_on_empty_tables(spark, corpus, tmp_path):
    folder = corpus[0]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    nothing = spark.read.parquet(f"{tmp_path}/documents.parquet")
    full = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    # Without labels or benchmark items nothing is known against a document.
    for stage in (corpus_pipeline.keep_quality, corpus_pipeline.drop_contaminated):
        assert stage(spark, full, str(tmp_path)).count() == full.count()


# --- near copies that the fingerprints bring together --------------------------------------


def apart_in_min_hashes(rng, n=3000):
    """Two long texts, nearly equal, that share none of the 32 min-hash cells and differ in at most 4 fingerprint bits."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
    spans = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + 5]), shingles.SEED) for i in range(n - 4)], np.uint64)
    own = np.unique(spans, return_index=True)
    # Words whose change takes a minimum out of every cell.
    mixed = own[0][:, None] * shingles._FACTORS
    mixed ^= mixed >> np.uint64(29)
    mixed *= shingles._FACTORS[::-1]
    places = own[1][mixed.argmin(0)].reshape(shingles.BANDS, shingles.ROWS)
    whole, changed = set(range(shingles.BANDS)), []
    while whole:
        hit = {p: {b for b in whole if ((p - 4 <= places[b]) & (places[b] <= p)).any()} for p in range(n)}
        changed.append(max(hit, key=lambda p: len(hit[p])))
        whole -= hit[changed[-1]]
    one = " ".join(words)
    for trial in range(200):
        other = " ".join(f"x{trial}y{i}" if i in changed else w for i, w in enumerate(words))
        if (simhash.fingerprint(one) ^ simhash.fingerprint(other)).bit_count() <= simhash.RADIUS:
            return one, other
    raise AssertionError("no such pair")


def test_near_copies_meet_by_their_fingerprints(spark):
    rng = random.Random(9)
    one, other = apart_in_min_hashes(rng)
    assert not set(shingles.bands(shingles.shingles(one))) & set(shingles.bands(shingles.shingles(other)))
    assert 0.9 < jaccard(shingle_set(one), shingle_set(other)) < 1
    # Linked by fingerprints alone: a line repeated a hundred times with different ends, too far apart as sets.
    line = "the same short line again and again "
    ends = [line * 100 + " ".join(f"e{i}n{rng.randrange(999)}" for _ in range(40)) for i in range(5)]
    assert all((simhash.fingerprint(ends[0]) ^ simhash.fingerprint(e)).bit_count() <= simhash.RADIUS for e in ends)
    # A text with words whose fingerprint is within 4 bits of those without any.
    words = (" ".join(f"q{rng.randrange(10**6)}" for _ in range(5)) for _ in range(200_000))
    faint = next(w for w in words if simhash.fingerprint(w).bit_count() <= simhash.RADIUS)
    texts = [other, *ends, None, faint, "", one, one + " " + one, faint.upper()]
    rows = [(100 - i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    want, best = groups_of(texts), {}
    for i, (doc, _) in enumerate(rows):
        best[want[i]] = min(doc, best.get(want[i], doc))
    assert want[texts.index(one)] == 0 and len(best) == 1 + len(ends) + 2
    assert kept == set(best.values())
