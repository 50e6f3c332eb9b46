"""Every operator against brute force on a small table with NULLs, empty and long texts, ties, repeated and clashing rows."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import (components, decontaminate, extract, language, mixing, phrase_dedup, repeats, search, secrets,
                          simhash, suffix_dedup, token_counts)
from starloom.llm.automata import compile_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, dedup string, target string"


def rows():
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 6))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    shared, base = text(70), text(120)
    texts = [None, "", " \t\n", "one", "one two", base, base, base.replace(" ", "  ", 1), base + " tail",
             text(40) + " " + shared + " " + text(30), shared, text(5) + "\n" + shared + "\n" + shared, text(9000),
             "12345 !!!", "Token = 'abcdef' password:abc AKIA" + "A1" * 9 + " " + "0a" * 14 + " é secret=xyzxyz1"]
    texts += [text(r.randint(1, 200)) for _ in range(45)]
    out = [(i, t, r.choice(["aa", "bb", None]), r.choice(["s1", "s2", "s10", None]), len(t or ""), "x", "y", "z")
           for i, t in enumerate(texts)]
    return out + [out[5], out[0], (None, base, "aa", "s1", 1, "x", "y", "z"), (None, None, None, None, None, None, None, None)]


ITEMS = "item_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def key(d):
    return (d[0] is not None, d[0] or 0)


def test_op1_containment(spark, docs):
    given = rows()
    item = [(1, given[9][1]), (1, given[9][1]), (2, given[3][1]), (10, " ".join(given[12][1].split()[500:530])), (None, given[4][1]),
            (5, None), (6, "--- "), (7, "notthere atall")]
    items = spark.createDataFrame(item, ITEMS)

    def fold(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    expected = Counter()
    for d in given:
        w, hit, found = fold(d[1]), set(), set()
        for i, t in item:
            q = fold(t)
            for win in [q[s:s + 10] for s in range(max(1, len(q) - 9))] if q else []:
                for s in range(len(w) - len(win) + 1):
                    if w[s:s + len(win)] == win:
                        hit |= set(range(s, s + len(win)))
                        found |= {str(i)} if i is not None else set()
        expected[(d[0], len(w), len(hit), tuple(sorted(found)))] += 1
    for block in (16 << 20, 600):
        marked, c = decontaminate.find_contamination(docs, items, block_bytes=block)
        assert marked.columns[:-1] == docs.columns
        got = Counter((r.doc_id, r[c].n_words, sum(b - a for a, b in r[c]["spans"]), tuple(r[c]["items"])) for r in marked.collect())
        assert got == expected
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == docs.count()
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0


def test_op2_bytes(docs):
    given = sorted(set(rows()), key=lambda d: (d[0] if d[0] is not None else -1))
    seen, expected = {}, {}
    plain = [d for d in given if d[0] is not None]
    null = [d for d in given if d[0] is None]
    for d in null + plain:
        b = (d[1] or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if seen.setdefault(b[i:i + 100], (d[0], i)) != (d[0], i):
                gone[i:i + 100] = b"\1" * 100
        expected[(d[0], d[1])] = (len(b), sum(gone), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    for shard, heavy in ((1 << 20, 1 << 22), (500, 1 << 22), (500, 300)):
        got, name = suffix_dedup.remove_repeats(docs, shard=shard, heavy=heavy)
        assert got.columns[:-1] == docs.columns
        for r in got.collect():
            d = r[name]
            assert (d.n_bytes, d.n_removed, suffix_dedup.digest(bytes(d.kept))) == expected[(r.doc_id, r.text)]
    assert got.count() == docs.count() and suffix_dedup.remove_repeats(docs.limit(0))[0].count() == 0


def test_op8_passages(docs):
    first = {}
    given = sorted(rows(), key=key)
    for d in given:
        w = words(d[1])
        for i in range(len(w) - 49):
            first.setdefault(b" ".join(w[i:i + 50]), key(d))
    for shard, heavy in ((1 << 20, 1 << 19), (300, 1 << 19), (300, 60)):
        got, name = phrase_dedup.remove_passages(docs, shard=shard, heavy=heavy)
        for r in got.collect():
            w, gone = words(r.text), set()
            for i in range(len(w) - 49):
                if first[b" ".join(w[i:i + 50])] < key((r.doc_id,)):
                    gone |= set(range(i, i + 50))
            assert r[name].n_removed == len(gone) and bytes(r[name].kept) == b" ".join(x for i, x in enumerate(w) if i not in gone)


def test_places_are_classified_alike_in_any_batches(spark):
    r = random.Random(5)
    plain = sorted((r.randrange(4), r.randrange(3) * r.randrange(2), r.randrange(5), 0, i, 2) for i in range(400))
    frame = spark.createDataFrame(plain, "h long, fh long, doc long, tie long, start long, n long")
    texts = {h: {x[1] for x in plain if x[0] == h} for h in range(4)}
    lone = [(9, 1, d, 0, d, 2) for d in range(30)]  # one text only
    frame = frame.union(spark.createDataFrame(lone, frame.schema)).union(spark.createDataFrame([(7, 7, 1, 0, 50, -3)], frame.schema))
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for w in (suffix_dedup.byte_windows(), phrase_dedup.word_windows()):
        expected, first = Counter(), {}
        for x in sorted(plain + lone, key=lambda x: (x[0], x[1], x[5], *x[2:5])):
            new = x[:2] not in first
            first.setdefault(x[:2], x[2])
            if not new and not (w.other_documents and x[2] == first[x[:2]]):
                expected[(None, *x[2:])] += 1
            elif len(texts.get(x[0], ())) > 1:
                expected[(x[0], *x[2:])] += 1
        expected[(None, 1, 0, 50, 3)] += 1
        for n in (1, 3, 1000):
            spark.conf.set(size, n)
            try:
                got = Counter(tuple(x) for x in repeats.classify(frame, w).collect())
            finally:
                spark.conf.unset(size)
            assert got == expected


def test_op4_fingerprints_and_components(spark, docs):
    def brute(text):
        w = words((text or "").lower() if (text or "").isascii() else text)
        w = [x.lower() for x in w]
        sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((d[0], f"{brute(d[1]):016x}") for d in rows())
    r = random.Random(3)
    fps = {r.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(r.choice([1, 3, 90])):
            f ^= 1 << r.randrange(64)
            f ^= (1 << r.randrange(64)) * r.randrange(2)
            fps.add(f)
    fps = sorted(fps)
    label = {f: f for f in fps}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                label[max(root(a), root(b))] = min(root(a), root(b))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    mine = {x.a: x.root for x in components.components(simhash.block_links(frame)).collect()}
    group = lambda f: mine.get(signed(f), signed(f))
    assert len({(root(f), group(f)) for f in fps}) == len({root(f) for f in fps}) == len({group(f) for f in fps})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len({x.component_id for x in got})
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_op5_against_full_scoring(docs):
    import math
    given = [(d[0], Counter(decontaminate.words((d[1] or "").encode()))) for d in rows()]
    n, mean = len(given), sum(sum(c.values()) for _, c in given) / len(given)
    df = Counter(w for _, c in given for w in c)
    queries = docs.filter("doc_id % 7 = 2").select("doc_id", "text")
    got = search.search(docs.select("doc_id", "text"), queries, k=4, query_bytes=2000, shard_bytes=5000).collect()
    for q, qc in given:
        if q is not None and q % 7 == 2:
            score = lambda c: round(sum(k * math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * c[w] * 2.2 / (
                c[w] + 1.2 * (.25 + .75 * sum(c.values()) / mean)) for w, k in qc.items() if w in c), 6)
            best = sorted((score(c) for _, c in given if score(c) > 0), reverse=True)[:4]
            assert [round(r.score, 6) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == pytest.approx(best, abs=2e-6)


def test_op6_spans_and_redaction(docs):
    rule = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    marked, name = secrets.find_secrets(docs)
    for r in marked.collect():
        t = r.text or ""
        base = [("assign", m.start(), m.end()) for m in rule.finditer(t) if len(m[2]) >= 6]
        base += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if m.end() - m.start() >= 20]
        base += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if m.end() - m.start() >= 24]
        assert sorted((x.kind, x.start, x.end) for x in r[name] if x.kind in secrets.BASE) == sorted(base)
    clean = secrets.redact(docs)
    assert clean.columns == docs.columns
    hit = clean.filter("doc_id = 14").first()
    assert hit.text.startswith("[assign]' password:abc [access] [hex] é [assign]") and hit.n_chars == len(hit.text)
    assert clean.filter("doc_id <> 14").exceptAll(docs.filter("doc_id <> 14")).isEmpty()


def test_automaton_is_minimal_and_right():
    a = compile_rules([("(ab|ac)+", False), ("b{2,3}", False)], anchored=True)
    def run(s):
        state = 0
        for b in s.encode():
            state = a.table[state, b]
        return int(a.accepts[state])
    assert [run(s) for s in ("ab", "abac", "bb", "bbb", "bbbb", "a", "")] == [1, 1, 2, 2, 0, 0, 0]
    assert compile_rules([("a|a", False)], anchored=True).table.shape[0] == 3


def test_op7_counts(docs):
    vocabulary = [b" ab", b"abc", b"bcd", b"cde", "é".encode(), b" a", b"dd", b"ddd", b"dde"]
    known = set(vocabulary) | {bytes([b]) for b in range(256)}
    def greedy(w):
        n = 0
        while w:
            w = w[next(k for k in range(len(w), 0, -1) if w[:k] in known):]
            n += 1
        return n
    counted, c = token_counts.count_tokens(docs, vocabulary=vocabulary)
    for r in counted.collect():
        assert r[c].n_tokens == sum(greedy(b" " + w) for w in words(r.text))


def test_op3_pages(spark):
    page = ("<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body class='with-sidebar'><header>Top</header><nav><ul><li>Menu"
            "</li></ul></nav><div class=\"cookie-notice\">We <div>use</div> cookies</div><article><h1>Head &amp; more</h1><p><b>One  two<br>three"
            "<p>Hi.</p><aside>side</aside><div class=\"ad\">buy</div><p>Last &lt;x&gt;\n line</p><section class='comments'><p>me too</p></section>"
            "</article><form>go</form><footer>&copy;</footer></body></html>")
    assert extract.main_text(page) == "Head & more\nOne two three\nHi.\nLast <x> line"
    long = "word " * 40
    assert extract.main_text(f"<div><a href=x>{long}</a></div><p>{long}</p><p>{long}</p><p></p>") == f"{long.strip()}\n{long.strip()}"
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "<p"), (4, "<article><p>a"), (4, "<article><p>a")], "page_id long, html string")
    found, name = extract.extract(frame)
    assert sorted((r.page_id, r[name]) for r in found.collect()) == [(1, ""), (2, ""), (3, ""), (4, "a"), (4, "a")]


def test_op9_held_out_accuracy(spark):
    r = random.Random(1)
    sounds = {"en": "the and ing tion er", "de": "sch ung ein der ich", "fr": "eau que les oi é"}
    text = lambda lang: " ".join("".join(r.choice(sounds[lang].split()) for _ in range(3)) for _ in range(30))
    labelled = spark.createDataFrame([(i, text(x), x) for i in range(40) for x in sounds], "id long, text string, lang string")
    langs, table = language.fit_text_model(labelled)
    pages = [(i, f"https://h{i % 4}.example.{x}/p", f"<html lang={x}><body><p>{text(x)}</p>", x) for i, x in enumerate(list(sounds) * 20)]
    pages += [(900, None, None, None), (901, "nonsense", "<p>12 34</p>", None), (901, "nonsense", "<p>12 34</p>", None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, truth string")
    got = language.identify_pages(frame, langs, table).collect()
    truth = {p[0]: p[3] for p in pages}
    assert len(got) == len(pages) and all(x.language == truth[x.page_id] for x in got)
    assert language.identify_pages(frame.limit(0), langs, table).count() == 0


def test_op10_targets_and_sizes(docs):
    got = mixing.mix_sizes(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_sizes(docs.repartition(5)).collect()), key=str)
    size = Counter()
    for d in rows():
        size[d[3]] += len(words(d[1]))
    names = sorted((s for s in size if s is not None)) + [None]
    weight = dict(zip(names, (5, 2, 1, 5)))
    target, over = dict.fromkeys(names, 0.0), sum(size.values())
    open_ = set(names)
    while over > 1e-9 and open_:
        for s in open_:
            target[s] += over * weight[s] / sum(weight[x] for x in open_)
        over = sum(max(0.0, target[s] - 3 * size[s]) for s in open_)
        full = {s for s in open_ if target[s] >= 3 * size[s]}
        target.update({s: 3.0 * size[s] for s in full})
        open_ -= full
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source] and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in names)
    assert mixing.mix_sizes(docs.limit(0)).count() == 0


def test_pipeline_on_a_small_folder(spark, tmp_path):
    kept = ("doc_id", "text", "lang", "source", "n_chars")
    frame = spark.createDataFrame([x[:5] for x in rows()], SCHEMA.split(", spans")[0])
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows()[20][1])], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).cache()
        assert tuple(docs.columns) == kept, name
    ids = [r.doc_id for r in docs.collect()]
    # no letters; copies of document 5 (the NULL id comes last) and the contaminated document are gone
    assert not {0, 1, 2, 13, 6, 20} & set(ids) and ids.count(5) == 1 and None not in ids
    assert {3, 9, 12, 14} <= set(ids)
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert set(kept) | {"mix_copies"} == set(final.columns) and {r.doc_id for r in final.collect()} <= set(ids)
