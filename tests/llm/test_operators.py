"""The text operators against brute force on small tables, with nulls, ties, repeats and clashing columns."""

import hashlib
import random
import re
import resource
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from marquee.llm import bpe, chunks, common, decontaminate, langid, lengths, private, quality, repeats, simhash, warc
from marquee.llm.components import components

RNG = random.Random(11)
WORDS = [f"w{i}x" for i in range(400)]
SHARED = " ".join(RNG.choice(WORDS) for _ in range(60))


def sentence(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


BASE = [sentence(RNG.randint(1, 150)) for _ in range(40)]
TEXTS = [
    *BASE, *BASE[:8], BASE[0].upper(), BASE[20] + " tail", None, "", "  \n", "É" + BASE[1], "a" * 30_000, "one two",
    *[sentence(10) + " " + SHARED + " " + sentence(10) for _ in range(5)], "z " * 300, sentence(6000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i % 13 else None, t, "x", 0.5, 7) for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3]]  # repeated rows
    names = "doc_id long, text string, row_ string, score double, kept int"  # clashing names
    return spark.createDataFrame(rows, names).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def lowered(text):
    return (text or "").encode().lower().decode()


def test_exact_groups(docs, empty):
    rows = docs.collect()
    groups = Counter(lowered(r.text) for r in rows)
    best = {}
    for r in rows:
        key = lowered(r.text)
        best[key] = max(best.get(key, -1), -1 if r.doc_id is None else r.doc_id)
    for identify in (chunks.digest, lambda c: F.substring(chunks.digest(c), 1, 1)):  # the second is ambiguous
        got = chunks.exact_groups(docs, ("doc_id", "text"), identify).collect()
        assert len(got) == len(rows)
        assert sum(r.kept for r in got) == len(groups)
        for r in got:
            key = lowered(r.text)
            assert r.group_size == groups[key] and (-1 if r.keep_id is None else r.keep_id) == best[key]
            assert r.text_sha256 == hashlib.sha256(key.encode()).hexdigest()
            assert not r.kept or r.doc_id == r.keep_id
    assert chunks.exact_groups(empty).count() == 0


def test_chunks_join_to_the_text(spark):
    df = spark.createDataFrame([(t or "",) for t in TEXTS], "text string")
    for r in df.select("text", chunks.chunks(F.col("text"), 16, 64).alias("c")).collect():
        assert "".join(r.c) == r.text and all(0 < len(c) <= 64 for c in r.c)


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    prints, root = sorted(set(prints)), {}
    for p in prints:
        if p in root:
            continue
        stack, root[p] = [p], p
        while stack:
            here = stack.pop()
            for q in prints:
                if q not in root and (here ^ q).bit_count() <= 4:
                    root[q] = p
                    stack.append(q)
    return root


def test_near_groups(docs, empty):
    got = simhash.near_groups(docs, ("doc_id", "text")).collect()
    prints = [brute_print(r.text) for r in got]
    root = brute_roots(prints)
    least = {}
    for r, p in zip(got, prints, strict=True):
        if r.doc_id is not None:
            least[root[p]] = min(least.get(root[p], r.doc_id), r.doc_id)
    for r, p in zip(got, prints, strict=True):
        assert r.fingerprint == f"{p:016x}" and r.component_id == least.get(root[p])
    assert len(got) == docs.count() and simhash.near_groups(empty).count() == 0


@pytest.mark.parametrize("block", [3, 4096])
def test_no_link_is_missed(spark, block):
    random_ = np.random.default_rng(4)
    prints = []
    for _ in range(60):
        p = int(random_.integers(0, 1 << 63)) * 2
        prints.append(p)
        for _ in range(8):  # chains of steps of up to six bits: some link, some do not
            for b in random_.choice(64, random_.integers(1, 7), replace=False):
                p ^= 1 << int(b)
            prints.append(p)
    signed = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in signed], "print_ long")
    found = {r.node: r.root for r in components(simhash.near_links(df, block)).collect()}
    root = brute_roots([p % (1 << 64) for p in signed])
    groups = lambda label: {frozenset(p for p in signed if label(p) == r) for r in set(map(label, signed))}
    assert groups(lambda p: found.get(p, p)) == groups(lambda p: root[p % (1 << 64)])


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (100, 100)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(i, 0) for i in range(1, 61)} | {(100, 99)}


def test_repeated_spans(docs, empty):
    window = 6
    rows = docs.collect()
    words = [(r.text or "").encode().split() for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    want = Counter()
    for r, w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want[r.doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    got = repeats.repeated_spans(docs, window=window, kmer=3).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)
    assert repeats.repeated_spans(empty).count() == 0


def test_tokens(docs, empty):
    path = public_tokenizers.path(bpe.RANKS)
    encoder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(path), special_tokens={})
    for r in bpe.token_digests(docs, ("doc_id", "text")).collect():
        ids = encoder.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = bpe.decode_ids(bpe.encode(docs, ("doc_id", "text")), ("text",))
    assert all(bytes(r["bytes"]).decode() == (r.text or "") for r in back.collect())
    assert bpe.token_digests(empty).count() == 0


def test_odd_texts_are_cut_like_the_library(monkeypatch):
    path, cut = public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN
    encoder = tiktoken.Encoding("t", pat_str=cut, mergeable_ranks=bpe.ranks(path), special_tokens={})
    alphabet = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "'s", "'ll", "1", "²", "!", "中", "🙂", "The", " of", "\r\n", "q" * 600]
    monkeypatch.setattr(bpe, "PIECE", 7)
    texts = ["".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, 14))) for _ in range(3000)]
    for name, value in (("LONG_STRETCH", 40), ("LONG_WORD", 20), ("TOGETHER", 500), ("CHUNK", 50)):
        for text, doc in zip(texts, bpe.encoded(texts, path, cut), strict=True):
            assert doc.columns()[0].tolist() == encoder.encode_ordinary(text)
        monkeypatch.setattr(bpe, name, value)
    other = r"\w+|\W"  # any other pattern
    encoder = tiktoken.Encoding("u", pat_str=other, mergeable_ranks=bpe.ranks(path), special_tokens={})
    for text, doc in zip(texts, bpe.encoded(texts, path, other), strict=True):
        assert doc.columns()[0].tolist() == encoder.encode_ordinary(text)


def test_long_words_and_stretches():
    path, cut = public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN
    encoder = tiktoken.Encoding("t", pat_str=cut, mergeable_ranks=bpe.ranks(path), special_tokens={})
    texts = ["".join(RNG.choice("abcdeilnorst") for _ in range(n)) for n in (255, 256, 257, 3000, 70_000)]
    texts += ["a" * 5000, "中文。" * 3000, " " * 3000, "\n \n" * 2000 + "x", "b " * 90_000]
    for text, doc in zip(texts, bpe.encoded(texts, path, cut), strict=True):
        assert doc.columns()[0].tolist() == encoder.encode_ordinary(text)


def test_a_million_blanks(spark):
    texts = [" " * 1_000_000, "x", None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    counts = sorted(r.n_tokens for r in bpe.token_lengths(docs).collect())
    assert counts[:3] == [0, 0, 1] and counts[3] == max(r.n_tokens for r in bpe.token_digests(docs).collect()) > 10_000
    assert all(r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest() for r in bpe.token_digests(docs).collect())


def test_folders_with_one_slash(docs, tmp_path, monkeypatch):
    places = iter(range(100))
    for module in (repeats, common):
        monkeypatch.setattr(module, "new_path", lambda spark, label: f"file:{tmp_path}/{label}-{next(places)}")
    assert repeats.repeated_spans(docs.limit(20)).count() == 20


def test_memory_stays_flat_without_blanks():
    def texts(n, seed):
        g = random.Random(seed)
        for _ in range(n):
            yield "".join(chr(g.randint(0x4E00, 0x9FFF)) if i % 12 else "。" for i in range(3000))

    path, cut = public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN
    bpe.encoded(texts(3000, 1), path, cut, bpe.Count)  # more than is gathered at a time
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    counts = bpe.encoded(texts(5000, 2), path, cut, bpe.Count)
    assert len(counts) == 5000 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss < before + 100_000


def test_token_lengths_end_to_end(docs, empty):
    encoder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(public_tokenizers.path(bpe.RANKS)), special_tokens={})
    numbers = [len(encoder.encode_ordinary(r.text or "")) for r in docs.collect()]
    report = lengths.limit_report(lengths.length_histogram(bpe.token_lengths(docs))).collect()
    assert {r.n_tokens: r.n_docs for r in report} == Counter(numbers)
    for r in report:
        assert r.tokens_truncated == sum(min(n, r.n_tokens) for n in numbers) and r.docs_over == sum(n > r.n_tokens for n in numbers)
    assert bpe.token_lengths(empty).count() == 0


def test_length_report(spark):
    numbers = [RNG.choice([0, 3, 3, 5000, 9000, RNG.randint(0, 20_000)]) for _ in range(500)]
    report = lengths.limit_report(lengths.length_histogram(spark.createDataFrame([(n,) for n in numbers], "n_tokens long")))
    rows = report.collect()
    assert {r.n_tokens: r.n_docs for r in rows} == Counter(numbers)
    for r in rows:
        fits = [n for n in numbers if n <= r.n_tokens]
        assert (r.docs_up_to, r.tokens_up_to, r.docs_over) == (len(fits), sum(fits), len(numbers) - len(fits))
        assert r.tokens_truncated == sum(min(n, r.n_tokens) for n in numbers) and r.tokens_over == sum(numbers) - sum(fits)
    middle = lengths.quantiles(report, [0.5]).first().n_tokens
    assert middle == sorted(numbers)[249]
    nothing = spark.createDataFrame([], "n_tokens long")
    assert lengths.limit_report(lengths.length_histogram(nothing)).count() == 0


def edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_contaminated(spark, docs, empty):
    items = [(i, " ".join(f"{a}{b}" for a, b in zip(WORDS[i * 20 :], "abcdefghijklmn", strict=False))) for i in range(8)]
    extra = []
    for i, text in items:
        chars = list(text)
        for _ in range(i):  # more and more edits
            at = RNG.randrange(len(chars))
            chars[at : at + 1] = RNG.choice([[], ["#"], ["#", "#"]])
        extra.append((1000 + i, "x y " + "".join(chars).upper() + " z"))
    table = docs.select("doc_id", "text").unionAll(spark.createDataFrame(extra, "doc_id long, text string"))
    benchmark = spark.createDataFrame([*items, (90, None), (91, ""), (None, "q")], "item_id long, text string")
    want = Counter()
    for r in table.collect():
        text = decontaminate.normal(r.text)
        for number, item in items:
            d = edit_distance_in(decontaminate.normal(item), text) if len(text) < 1000 else 10**6
            if d <= decontaminate.budget(len(decontaminate.normal(item))):
                want[r.doc_id, number, d] += 1
    assert len(want) >= 4
    for block in (100, 10**6):
        got = decontaminate.contaminated(table, benchmark, block_chars=block).collect()
        assert Counter((r.doc_id, r.item_id, r.distance) for r in got) == want
    clean = decontaminate.uncontaminated(table, benchmark)
    assert clean.count() == table.count() - len({d for d, _, _ in want})
    assert decontaminate.contaminated(empty, benchmark).count() == 0
    assert decontaminate.contaminated(table, benchmark.limit(0)).count() == 0


FORMS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def forms(text):
    for kind, form in FORMS:
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15):
                yield f"{kind}:{m.start()}:{m.end()}"


def test_personal_data(spark, empty):
    bits = ["a", "b@", "@", ".", "..", "1", "25", "256", " ", "-", "+", "(", ")", "é", "🙂", "_", "%", "x.y", "4111 1111 1111 1111",
            " 10.0.0.1", "+1 (988) 555-2485", "a@b.c", "\n", "0"]
    texts = ["".join(RNG.choice(bits) for _ in range(RNG.randint(0, 12))) for _ in range(2000)]
    texts += [None, "", "1" * 50_000, "1 " * 30_000, "a" * 100_000, "a." * 50_000 + "@" + "b." * 50_000 + "c", "1." * 40_000]
    # A context that only e-mail addresses stand in, and one address whose form the pattern misses.
    texts += [f"write mailbox: user{i}@site{i}.org today" for i in range(9)] + ["write mailbox: user77@localhost today"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r for r in private.personal_data(df).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        own = list(forms(text))
        assert got[i].base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert [getattr(got[i], f"n_{k}") for k in private.KINDS] == [sum(x.startswith(k) for x in own) for k in private.KINDS]
        assert set(own) <= set(got[i].spans.split(",")) | {""}
    last = got[len(texts) - 1]
    assert (last.n_added, last.spans) == (1, "email:15:31")
    assert private.personal_data(empty).count() == 0


def test_contexts_of_whole_spans(spark):
    """Identifiers whose form fails, in contexts learned from known ones: found whole, however they are spaced or padded."""
    def luhn(digits):
        total = sum((2 * d - 9 * (d > 4)) if i % 2 == 0 else d for i, d in enumerate(map(int, reversed(digits))))
        return str(-total % 10)

    pad = " " * 70
    texts = [f"call telephone +1 (20{i}) 555-01{i}{i} please" for i in range(9)]
    cards = [f"411{i}22223333{i}44" for i in range(9)]
    cards = [c + luhn(c) for c in cards]
    texts += [f"charge visa {c[:4]} {c[4:8]} {c[8:12]} {c[12:]} soon" for c in cards]
    texts += [f"from host 10.0.{i}.7 port" for i in range(9)]
    texts += [f"write mailbin:{pad}user{i}@site{i}.org{pad}today" for i in range(9)]
    hidden = {
        "call telephone 974 555 3436 please": "phone:15:27",
        "charge visa 4111 1111 1111 1112 soon": "card:12:31",
        "from host 10.0.999.7 port": "ip:10:20",
        f"write mailbin:{pad}user77@localhost{pad}today": "email:84:100",
    }
    rows = list(enumerate(texts + list(hidden)))
    got = {r.doc_id: r for r in private.personal_data(spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_email int, email_ string")).collect()}
    assert {t: got[len(texts) + i].spans for i, t in enumerate(hidden)} == hidden
    assert all(got[i].n_added == 0 for i in range(len(texts)))


def test_languages(spark, docs, empty):
    sounds = {"aa": "aeioulmnr", "bb": "kztgxqwyv", "cc": "éüößäfhpd"}
    rows = []
    for i in range(240):
        lang = sorted(sounds)[i % 3]
        rows.append((i, " ".join("".join(RNG.choice(sounds[lang]) for _ in range(RNG.randint(2, 8))) for _ in range(30)), lang))
    rows += [(500, None, "aa"), (501, "123 !", "aa"), (None, "aeiou lmnr", None), (3, rows[3][1], rows[3][2])]
    got = langid.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), ("doc_id", "text", "lang")).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1}
    judged = [r for r in held if r.text and r.doc_id < 500]
    assert np.mean([r.lang_pred == r.lang for r in judged]) > 0.95 and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (500, 501)} == {"und"}
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.languages(nothing).collect()} == {"und"}
    assert langid.languages(empty.withColumn("lang", F.lit("a"))).count() == 0


def test_quality(spark, sf_dir, docs, empty):
    source, labels = (spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(source, labels).join(labels, "doc_id").collect()
    good, bad = ([r.score for r in got if r.held_out and r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.93 and np.mean([g >= 0.7 for g in good]) > 0.95
    none = labels.limit(0)
    scores = quality.quality_scores(docs, none).collect()
    assert len(scores) == docs.count() and {r.score for r in scores} == {quality.UNTAUGHT}
    assert quality.accepted(docs, none).count() == docs.count() and quality.quality_scores(empty, labels).count() == 0
    few = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.quality_scores(docs, few).count() == docs.count()


def test_pool_adjacent():
    score, weight, target = np.arange(5.0), np.ones(5), np.array([0.0, 1.0, 0.0, 0.5, 1.0])
    assert quality.pool_adjacent(score, weight, target)[1].tolist() == [0.0, 0.5, 1.0]


def test_archive(spark):
    pages = [(i, f"http://h{i % 7}.example.org:80/p?{i}#f", BASE[i % 30]) for i in range(60)]
    pages += [(60, None, None), (61, "http://x\r\n/", ""), (None, "ftp://u@Q.w/", BASE[2]), (5, pages[5][1], pages[5][2]), (62, "é", "é\r\n\r\nWARC/1.1")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha", F.lit(1)).repartition(4)
    archive, folder = warc.write_archive(df, block_lines=4)
    got = warc.lookup(archive, folder, archive.captures, with_payload=True).collect()
    keep = {}
    for p, _, html in pages:
        keep[html or ""] = max(keep.get(html or "", -1), -1 if p is None else p)
    want, seen = Counter(), set()
    for p, _, html in pages:
        raw, first = (html or "").encode(), keep[html or ""]
        kept = p == first and html not in seen
        if kept:
            seen.add(html)
        want[p, len(raw), warc.sha1_base32(raw), "response" if kept else "revisit", None if kept else first] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(bytes(r.payload) == (dict((p, h) for p, _, h in pages)[r.page_id] or "").encode() for r in got if r.payload is not None)
    one = spark.createDataFrame([(warc.url_key(pages[3][1]),), ("no such",), (None,)], "key string")
    assert [r.page_id for r in warc.lookup(archive, folder, one).collect()] == [3]
    assert archive.directory.count() >= len(pages) // 4
    archive, folder = warc.write_archive(df.limit(0))
    assert warc.lookup(archive, folder, archive.captures).count() == 0


def test_small_payloads_are_always_responses(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "long text"), (4, "d", "long text")], "page_id long, url string, html string")
    archive, folder = warc.write_archive(df, least_bytes=5)
    kinds = {r.page_id: r.record_type for r in warc.lookup(archive, folder, archive.captures).collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archive_with_one_payload_and_one_url_key_for_a_third_each(spark):
    template = "<p>template</p>" * 20
    pages = [(i, None if i % 3 == 1 else f"http://h{i}.org/", template if i % 3 == 0 else f"page {i}") for i in range(3000)]
    pages += [(2997, "again", template), (2997, "again", template), *[(None, f"u{i % 2}", "no id") for i in range(5)]]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = warc._decided(df, 0).select("html", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(Counter(r.task for r in placed if r.html == template).values()) < 500  # of 1,002 rows over 8 tasks
    archive, folder = warc.write_archive(df, block_lines=50)
    got = warc.lookup(archive, folder, archive.captures).collect()
    assert Counter(r.page_id for r in got) == Counter(p for p, _, _ in pages)
    same = [r for r in got if r.payload_bytes == len(template)]
    assert [r.page_id for r in same if r.record_type == "response"] == [2997] and {r.refers_to for r in same} == {None, 2997}
    assert Counter((r.record_type, r.refers_to) for r in got if r.page_id is None) == {("response", None): 1, ("revisit", None): 4}
    hot = spark.createDataFrame([("",), ("org,h2)/",)], "key string")
    assert sorted(r.page_id for r in warc.lookup(archive, folder, hot).collect()) == sorted([2, *range(1, 3000, 3)])
    # The blocks of the hot key come as rows of their own, which later tasks share.
    keys = hot.coalesce(1).sortWithinPartitions("key").mapInArrow(warc._locator(archive.directory_uri), warc.PLACE_SQL)
    assert keys.where(F.array_contains("keys", "")).count() >= 20
