"""Every operator against brute force on a small corpus, and its defined results for odd tables."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lexgate.llm import blocks, bpe, components, fingerprints, hard_negatives, line_dedup, lm_scoring, near_dedup, packing, quality_rules, sharding, spelling, substring_dedup, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def by_id(df):
    return {r[0]: r for r in df.collect()}


@pytest.fixture(scope="module")
def texts(corpus):
    return {r[0]: r[1] or "" for r in corpus}


# ---- 1


def test_fingerprints(docs, texts):
    got, order = by_id(fingerprints.fingerprint_edits(docs)), sorted(texts)
    assert set(got) == set(order)

    def phrases(t):
        seen, cur = set(), ""
        for c in t:
            cur += c
            if cur not in seen:
                seen.add(cur)
                cur = ""
        return seen | ({cur} if cur else set())

    for i, d in enumerate(order):
        t, nxt = texts[d], texts[order[(i + 1) % len(order)]]
        h = len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for value, other in ((got[d].near_edited, edited), (got[d].near_next, nxt)):
            a, b = phrases(t), phrases(other)
            assert abs(value - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.2
    twins = [got[d].fingerprint for d in order if texts[d] == texts[order[0]]]
    assert len(twins) > 5 and len(set(twins)) == 1
    assert got[[d for d in order if texts[d] == ""][0]].fingerprint == ""
    alone = by_id(fingerprints.lz_fingerprint(docs))
    assert all(alone[d].fingerprint == got[d].fingerprint for d in order)


def test_fingerprints_of_odd_tables(odd, nothing):
    assert fingerprints.fingerprint_edits(nothing).count() == 0
    rows = fingerprints.fingerprint_edits(odd).collect()
    assert sorted(r.doc_id or 0 for r in rows) == [0, 5, 5, 5, 7]


def test_a_parse_continues():
    t = "abcab" * 100
    a = fingerprints.Parse().feed(t)
    b = fingerprints.Parse().feed(t[:33]).copy().feed(t[33:120]).feed(t[120:])
    assert sum(a.lengths) + len(a.open) == len(t) and len(a.seen) == len(a.lengths)
    assert (fingerprints.signature(t, a) == fingerprints.signature(t, b)).all()


def test_more_ranges_of_ids_give_the_same_rows(docs, monkeypatch):
    whole = sorted(map(tuple, fingerprints.fingerprint_edits(docs).collect()))
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 1000)
    assert sorted(map(tuple, fingerprints.fingerprint_edits(docs).collect())) == whole


# ---- 2


def check_packing(rows, wanted):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(wanted)
    for d, ids in wanted.items():
        at = 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(ids[at : at + r.length].tobytes()), len(ids))
            at += r.length
        assert at == len(ids)
    for rows_of in sequences.values():
        at = 0
        for r in sorted(rows_of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return sum(len(i) for i in wanted.values()) / (1024 * len(sequences))


def test_packing(docs, texts):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(bpe.default_path())
    wanted = {d: np.array([*tk.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for d, t in texts.items()}
    assert check_packing(packing.pack_documents(docs).collect(), wanted) > 0.9


def test_packing_of_odd_tables(odd, nothing):
    assert packing.pack_documents(nothing).count() == 0
    rows = packing.pack_documents(odd).collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)


def test_differencing():
    r = np.random.RandomState(1)
    for k in (1, 2, 7, 40):
        sizes = r.randint(1, 300, 5 * k).tolist()
        bins = packing.kk_partition(sizes, k)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and len(bins) == k
        sums = [sum(sizes[i] for i in b) for b in bins]
        assert max(sums) - min(sums) <= max(sizes)
    assert packing.kk_partition([8, 7, 6, 5, 4], 2) and packing.kk_partition([], 3) == [[], [], []]
    assert sorted(packing.windows_of([1000] * 5, 1024)) == [[(i, 0, 1000)] for i in range(5)] and packing.windows_of([], 9) == []
    sizes = r.randint(1, 1024, 900).tolist()
    windows = packing.windows_of(sizes, 1024)
    pieces = sorted(x for w in windows for x in w)
    assert max(sum(n for _, _, n in w) for w in windows) <= 1024 and sum(sizes) / 1024 / len(windows) > 0.97 and len(pieces) < 2.5 * len(sizes)
    # the count rises until differencing fits, whatever the sizes: nothing is cut afterwards
    for sizes in ([400] * 400, [600] * 300, [1000] * 60, [513] * 200, [3] * 10, [1023, 5]):
        windows = packing.windows_of(sizes, 1024)
        loads, least = [sum(n for _, _, n in w) for w in windows], -(-sum(sizes) // 1024)
        assert max(loads) <= 1024 and sum(loads) == sum(sizes) and least <= len(windows) <= max(least + 1, 1.026 * least + 1)
        items = packing.crumbled(sizes, 10)
        fits = [max(sum(items[i][2] for i in b) for b in packing.kk_partition([n for *_, n in items], k)) <= 1024 for k in (least, len(windows))]
        assert len(windows) == least or not fits[0]
    sizes = r.randint(1, 1024, 900).tolist()
    pieces = sorted(x for w in packing.windows_of(sizes, 1024) for x in w)
    for i, size in enumerate(sizes):
        own = [(a, n) for j, a, n in pieces if j == i]
        assert [a for a, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) == size


def test_long_blank_runs_are_packed(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(bpe.default_path())
    texts = {1: "a" + " " * 5000 + "b", 2: " " * 30000, 3: "\n" * 4000 + "<|endoftext|>" + "\t \n" * 3000 + "é", 4: " " * 1_200_000 + "x", 5: "w" * 30000}
    wanted = {d: np.array([*tk.encode(t, add_special_tokens=False).ids, 0], dtype="<u4") for d, t in texts.items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check_packing(packing.pack_documents(docs).collect(), wanted)
    assert {r.doc_id: np.array(r.ids, dtype="<u4").tolist() for r in bpe.bpe_encode(docs).collect()} == {d: ids[:-1].tolist() for d, ids in wanted.items()}


# ---- 3


def test_sharding(docs, texts):
    got = by_id(sharding.shard_by_splitters(docs, 4))
    sizes, slots = defaultdict(int), defaultdict(list)
    for d, t in texts.items():
        r = got[d]
        assert r["size"] == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode())
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(4))
    largest = max(r["size"] for r in got.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_sharding_of_a_hot_text_and_odd_tables(spark, odd, nothing):
    hot = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('hot ', 20), concat('t', id, repeat('x', 70))) as text")
    rows = sharding.shard_by_splitters(hot, 6).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["size"]
    assert len(rows) == 3000 and max(sizes.values()) < 1.05 * min(sizes.values())
    assert sharding.shard_by_splitters(nothing, 3).count() == 0
    assert sorted(r.doc_id or 0 for r in sharding.shard_by_splitters(odd, 3).collect()) == [0, 5, 5, 5, 7]


@pytest.mark.parametrize("doc_id", ["7", "cast(null as long)", "id div 900"])
def test_sharding_draws_each_row_for_itself(spark, doc_id):
    """Rows that share an id, equal rows too, are sampled one by one and divided between ranges."""
    same = spark.range(6000).selectExpr(f"{doc_id} as doc_id", "'one text for all rows' as text", "1 as row", "2 as key")
    wanted = 300
    drawn = sharding._draw(same.selectExpr("monotonically_increasing_id() as row", "29L as size", "5L as key"), 29 * 6000, wanted, 1)
    assert 0.7 * wanted < len(drawn) < 1.3 * wanted
    rows = sharding.shard_by_splitters(same, 5).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == 6000 and max(sizes.values()) - min(sizes.values()) <= 2 and len(sizes) == 5
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in sizes.items())


# ---- 4 and 8


def brute_words(texts, w):
    words, seen, out = {d: WORD.findall(t) for d, t in texts.items()}, Counter(), {}
    for x in words.values():
        seen.update(tuple(x[i : i + w]) for i in range(len(x) - w + 1))
    for d, x in words.items():
        gone = set()
        for i in range(len(x) - w + 1):
            if seen[tuple(x[i : i + w])] > 1:
                gone.update(range(i, i + w))
        kept = " ".join(v for i, v in enumerate(x) if i not in gone)
        out[d] = (len(x), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def brute_bytes(texts, n):
    seen, out = set(), {}
    for d in sorted(texts):
        b = texts[d].encode()
        mask = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if b[i : i + n] in seen:
                mask[i : i + n] = b"\1" * n
            seen.add(b[i : i + n])
        kept = bytes(x for x, m in zip(b, mask, strict=True) if not m)
        out[d] = (len(b), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("window", [35, 13])
def test_word_windows(docs, texts, window):
    got = by_id(substring_dedup.dedup_words(docs, window))
    want = brute_words(texts, window)
    assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in got.items()} == want
    assert sum(w[1] > 0 for w in want.values()) > 10


@pytest.mark.parametrize(("window", "records"), [(35, 10000), (13, 7)])
def test_factors_repeat_their_sources(spark, docs, texts, window, records):
    """Each factor repeats another place word for word, factors are disjoint, greedy, and cover what windows cover."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
    got = {r.doc_id: r.factors for r in substring_dedup.factor_words(docs.repartition(5), window).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    words, want = {d: WORD.findall(t) for d, t in texts.items()}, brute_words(texts, window)
    several = 0
    for d, found in got.items():
        covered = set()
        for f in found:
            assert (f.source, f.source_start) != (d, f.start) and f.n > 0 and not covered & set(range(f.start, f.start + f.n))
            assert words[d][f.start : f.start + f.n] == words[f.source][f.source_start : f.source_start + f.n]
            covered.update(range(f.start, f.start + f.n))
        for f, g in zip(found, found[1:]):
            assert f.start < g.start and not (g.start == f.start + f.n and g.source == f.source and g.source_start - g.start == f.source_start - f.start)
        assert len(covered) == want[d][1]
        several += len(found) > 1
    copies = [d for d, t in texts.items() if t == texts[3]]
    assert len(copies) > 5 and several and all(sum(f.n for f in got[d]) == len(words[d]) for d in copies)
    if records > len(texts):  # one lot a task: a copy is one factor
        assert all(len(got[d]) == 1 for d in copies)


def test_greedy_parse():
    span = lambda a, n, d, s: {"start": a, "n": n, "source": d, "source_start": s}
    assert blocks.factors([]) == []
    assert blocks.factors([span(5, 40, 9, 105), span(20, 40, 9, 120), span(61, 35, 9, 161)]) == [(5, 55, 9, 105), (61, 35, 9, 161)]
    assert blocks.factors([span(0, 40, 9, 0), span(30, 40, 8, 30)]) == [(0, 40, 9, 0), (40, 30, 8, 40)]
    assert blocks.factors([span(0, 80, 9, 0), span(10, 35, 8, 7), span(70, 40, 9, 70)]) == [(0, 110, 9, 0)]


@pytest.mark.parametrize("length", [100, 40])
def test_byte_strings(docs, texts, length):
    got = by_id(substring_dedup.dedup_bytes(docs, length))
    want = brute_bytes(texts, length)
    assert {d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()} == want
    assert sum(w[1] > 0 for w in want.values()) > 10


def test_pieces_of_long_texts(docs, texts, monkeypatch):
    rows = [(d, t.encode()) for d, t in sorted(texts.items())]
    from lexgate.llm.words import bytes_as_units

    whole = blocks.block_table(np.array([r[0] for r in rows]), (bytes_as_units(r[1]) for r in rows), 100, 32)
    monkeypatch.setattr(blocks, "BUFFER", 500)
    cut = blocks.block_table(np.array([r[0] for r in rows]), (bytes_as_units(r[1]) for r in rows), 100, 32)
    windows = lambda columns: sorted((d, s + i) for d, p in zip(columns[2].tolist(), columns[3].tolist(), strict=True) for s, n in [(p >> 18, (p >> 2) & 0xFFFF)] for i in range(n))
    assert windows(whole) == windows(cut) == sorted((d, i) for d, b in rows for i in range(len(b) - 99))


def test_substrings_of_odd_tables(odd, nothing):
    assert substring_dedup.dedup_bytes(nothing).count() == 0 and substring_dedup.dedup_words(nothing).count() == 0
    rows = substring_dedup.dedup_bytes(odd, 20).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 0), (5, 0), (5, 31), (5, 31), (7, 0)]
    clash = odd.withColumnsRenamed({"source": "spans_", "lang": "id_"}).selectExpr("*", "1 as id", "2 as row", "3 as drop_")
    assert substring_dedup.strip_repeated_bytes(clash, 20).columns == clash.columns
    assert sorted(substring_dedup.strip_repeated_bytes(odd, 20).columns) == sorted(odd.columns)


def test_rows_that_share_an_id(spark, monkeypatch):
    """No row is an earlier copy of another of its id, across lots and tasks, and each has its own places."""
    r = np.random.RandomState(5)
    prose = lambda n: " ".join("".join(map(chr, r.randint(97, 123, 6))) for _ in range(n))
    same, passage, own = prose(40), prose(30), prose(50)
    rows = [(5, same)] * 3 + [(5, own + passage), (5, passage + " tail " + passage), (6, same), (6, own), (7, passage), (None, prose(30)), (None, prose(4)), (8, "short")]
    want = [(5, same)] * 3 + [(5, own + passage), (5, passage + " tail "), (6, ""), (6, ""), (7, "")] + rows[8:]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda x: (x[0] or 0, x[1])
    for parts, records in ((1, 10000), (4, 10000), (4, 1)):
        monkeypatch.setattr("lexgate.llm.blocks.BUFFER", 500) if records == 1 else None
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
        got = [(x.doc_id, x.text) for x in substring_dedup.strip_repeated_bytes(docs.repartition(parts), 100).collect()]
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted(got, key=key) == sorted(want, key=key)
    twins = docs.where("doc_id = 5 and length(text) = " + str(len(same)))
    assert [x.n_removed for x in substring_dedup.dedup_bytes(twins, 100).collect()] == [0, 0, 0]


def test_stripping_keeps_characters(spark):
    docs = spark.createDataFrame([(1, "x" + "éa" * 80), (2, "y" + "éa" * 80)], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in substring_dedup.strip_repeated_bytes(docs, 100).collect()}
    assert rows[2] == "y" and rows[1].startswith("xé")


# ---- 5


def test_bpe_against_the_library(docs, texts):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(bpe.default_path())
    got = by_id(bpe.bpe_decode(bpe.bpe_encode(docs)))
    for d, t in texts.items():
        ids = tk.encode(t, add_special_tokens=False).ids
        assert list(got[d].ids) == ids and got[d].text == tk.decode(ids, skip_special_tokens=False)


def test_bpe_on_random_strings():
    from tokenizers import Tokenizer

    r = np.random.RandomState(4)
    tk, own, fast = Tokenizer.from_file(bpe.default_path()), bpe.load(bpe.default_path()), packing.fast_encoder(bpe.default_path())
    signs = ["a", " ", "  ", "\n", "'s", "'ll", "12", "é", "中", " ", " ", "\x1c", "\x85", "​", "½", "Ⅷ", "<|endoftext|>", "!", "_", "\U0001f600", "ing", "́", "\x00", "aaaa"]
    for _ in range(1500):
        t = "".join(r.choice(signs, r.randint(0, 40)))
        ids = tk.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids == fast.encode(t, allowed_special="all")
        assert own.decode(ids) == tk.decode(ids, skip_special_tokens=False)
    some = r.randint(0, 50257, 30)
    assert own.decode(some) == tk.decode(some.tolist(), skip_special_tokens=False)


def test_bpe_of_odd_tables(odd, nothing):
    assert bpe.bpe_encode(nothing).count() == 0
    assert sorted(len(r.ids) == 0 for r in bpe.bpe_encode(odd).collect()) == [False] * 4 + [True]


# ---- 6


@pytest.mark.parametrize("sites", [3, 10])
def test_lines(docs, corpus, sites):
    where, first = defaultdict(set), {}
    strip = lambda s: s.strip(" \t\n\x0b\x0c\r")
    for d, t, s, *_ in sorted(corpus, key=lambda r: r[0]):
        for i, line in enumerate((t or "").split("\n")):
            if strip(line):
                where[strip(line)].add(s)
                first.setdefault(strip(line), (d, i))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, sites).collect()}
    for d, t, *_ in corpus:
        if t is None:
            assert got[d].text is None
            continue
        kept = [x for i, x in enumerate(t.split("\n")) if len(where[strip(x)]) < sites or first[strip(x)] == (d, i)]
        assert (got[d].text, got[d].spans) == ("\n".join(kept), "clash")
    assert any(len(w) >= sites for w in where.values())


def test_lines_of_odd_tables(odd, nothing):
    assert line_dedup.dedup_lines(nothing).count() == 0
    assert line_dedup.dedup_lines(odd, 2).count() == 5
    clash = odd.selectExpr("*", "1 as row", "2 as drop", "3 as drop_", "4 as n_lines_", "5 as id_")
    assert line_dedup.dedup_lines(clash, 2).count() == 5


def test_lines_of_rows_that_share_an_id(spark):
    rows = [(i, "common line\nown " + str(i), f"s{i}") for i in range(1, 5)] + [(9, "precious unique sentence\ntail a", "s5"), (9, "common line\ntail b", "s6"), (9, "common line\ntail b", "s6"), (None, "common line\nfirst", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id or 0, r.text) for r in line_dedup.dedup_lines(docs, 3).collect())
    want = [(0, "common line\nfirst"), *((i, f"own {i}") for i in range(1, 5)), (9, "precious unique sentence\ntail a"), (9, "tail b"), (9, "tail b")]
    assert got == sorted(want)


# ---- 7


def brute_model(tokens, held, order):
    """log10 probability of each text: every longer context of a symbol counts once below, method D, exclusion."""
    coded = {d: "\n" * order + "".join(w if w == "\n" else w + " " for w in ws) for d, ws in tokens.items()}
    coded = {d: t.encode() for d, t in coded.items()}
    trie = [defaultdict(Counter) for _ in range(order + 1)]
    for d, b in coded.items():
        if not held[d]:
            for i in range(order, len(b)):
                trie[order][b[i - order : i]][b[i]] += 1
    for k in range(order, 0, -1):
        for context, symbols in trie[k].items():
            for s in symbols:
                trie[k - 1][context[1:]][s] += 1

    def symbol(context, s):
        out, gone = 0.0, set()
        for k in range(order, -1, -1):
            live = {a: n for a, n in trie[k].get(context[len(context) - k :], {}).items() if a not in gone}
            if s in live:
                return out + math.log10((live[s] - 0.5) / sum(live.values()))
            if live:
                out += math.log10(len(live) / 2 / sum(live.values()))
                gone |= set(live)
        return out + math.log10(1 / (256 - len(gone)))

    return {d: sum(symbol(b[i - order : i], b[i]) for i in range(order, len(b))) for d, b in coded.items()}, symbol


@pytest.mark.parametrize(("order", "block", "parts"), [(5, 1 << 24, 1 << 22), (5, 900, 500), (2, 5000, 3000)])
def test_model_against_brute_force(docs, texts, monkeypatch, order, block, parts):
    """Blocks and parts of any size give the same scores."""
    monkeypatch.setattr(lm_scoring, "BLOCK", block)
    monkeypatch.setattr(lm_scoring, "PART_BYTES", parts)
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    tokens = {d: WORD.findall(lower(t)) + ["\n"] for d, t in texts.items()}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    from pyspark.sql import functions as F

    got = {r.doc_id: r for r in lm_scoring.score_texts(docs, lambda c: F.crc32(c.cast("string").cast("binary")) % 7 == 2, order=order).collect()}
    want, symbol = brute_model(tokens, held, order)
    assert set(got) == set(texts) and any(held.values())
    for d, ws in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ws), sum(w in counts for w in ws), total)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(want[d], rel=1e-7)  # values have 24 bits
    for context in (b"\n\n\n\n\n", b"onti ", b"zzzzz", b"he an"):
        assert sum(10 ** symbol(context[5 - order :], s) for s in range(256)) == pytest.approx(1.0)


def test_a_context_reaches_five_bytes_back(spark):
    rows = [(i, f"{i % 2}abcd{'xy'[i % 2]}") for i in range(20)] + [(100, "q0abcdx"), (101, "q1abcdx")]
    got = by_id(lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), lambda c: c >= 100))
    assert got[100].score > got[101].score + 0.3


def test_contexts_cross_words(spark):
    rows = [(i, "ab cd ef gh"[:: 1 if i % 2 else -1]) for i in range(40)] + [(100, "ab cd ef gh"), (101, "cd ab gh ef")]
    got = by_id(lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), lambda c: c >= 100))
    assert got[100].base_score == pytest.approx(got[101].base_score) and got[100].score > got[101].score + 3


def test_held_out_text_of_the_same_kind_scores_better(spark):
    r = np.random.RandomState(6)
    parts = ["an", "the", "ti", "on", "ing", "re", "es"]
    text = lambda: " ".join("".join(r.choice(parts, r.randint(1, 4))) for _ in range(200))
    rows = [(i, text()) for i in range(60)] + [(100, text()), (101, text()[::-1])]
    got = by_id(lm_scoring.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), lambda c: c >= 100))
    assert got[100].score > got[101].score + 100


def test_model_of_odd_tables(spark, odd, nothing):
    from pyspark.sql import functions as F

    hold = lambda c: F.lit(False)
    assert lm_scoring.score_texts(nothing, hold).count() == 0
    rows = lm_scoring.score_texts(odd, hold).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == [(0, 7), (5, 3), (5, 7), (5, 7), (7, 1)]
    assert all(r.held_out for r in lm_scoring.score_texts(odd, lambda c: F.lit(True)).collect())
    untrained = lm_scoring.score_texts(odd, lambda c: F.lit(True)).where("doc_id = 7").first()
    assert (untrained.train_tokens, untrained.n_known) == (0, 0) and untrained.score == pytest.approx(math.log10(1 / 256))
    with pytest.raises(ValueError):
        lm_scoring.score_texts(odd, hold, order=9)


# ---- 9


def brute_near(texts, width, percent):
    sets = {}
    for d, t in texts.items():
        w = WORD.findall(lower(t))
        sets[d] = frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, texts, width, percent):
    got = by_id(near_dedup.near_duplicates(docs, width, percent))
    assert {d: (r.n_shingles, r.component_id) for d, r in got.items()} == brute_near(texts, width, percent)


def test_bands_follow_the_threshold():
    for percent in range(1, 101):
        bands, rows = near_dedup.banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 4e-5
    assert near_dedup.banding(85) == (32, 8) and near_dedup.banding(80) == (42, 6)
    with pytest.raises(ValueError):
        near_dedup.banding(0)


@pytest.mark.parametrize(("percent", "shared", "pairs"), [(80, 8, 3000), (50, 2, 300)])
def test_pairs_at_the_threshold(spark, percent, shared, pairs):
    rows = [(2 * i + k, " ".join([*(f"w{i}x{j}" for j in range(shared)), f"own{i}x{k}"])) for i in range(pairs) for k in (0, 1)]
    got = by_id(near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, percent))
    assert [d for d, r in got.items() if r.component_id != d - d % 2] == []


def test_large_group_of_near_copies(spark, monkeypatch):
    """Members of one bucket that are no neighbours of its least member, with small rounds."""
    monkeypatch.setattr(near_dedup, "CENTRES", 4)
    r = np.random.RandomState(2)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for i in range(120):
        words = list(base)
        for j in r.choice(150, r.randint(0, 7), replace=False):
            words[j] = f"n{i}_{j}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = by_id(near_dedup.near_duplicates(docs, 3, 85))
    assert {d: (x.n_shingles, x.component_id) for d, x in got.items()} == brute_near(texts, 3, 85)


def test_near_duplicates_of_odd_tables(odd, nothing):
    assert near_dedup.near_duplicates(nothing).count() == 0
    rows = near_dedup.near_duplicates(odd).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (5, 0), (5, 0), (5, 5), (7, 7)]
    assert near_dedup.drop_near_copies(nothing).count() == 0
    kept = near_dedup.drop_near_copies(odd.withColumnRenamed("source", "row").selectExpr("*", "1 as row_"))
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "the same words stand here again"), (5, "other words"), (7, "")]


def test_near_copies_of_rows_that_share_an_id(spark):
    """A row of a shared id is grouped by its own text, and one row of each group stays, null ids and equal rows included."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(3, text(1)), (9, text(2)), (9, text(3)), (12, text(3)), (12, text(3)), (None, text(4)), (4, text(4)), (8, text(4)), (20, text(5)), (20, text(5)), (2, text(3) + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in near_dedup.near_duplicates(docs).collect())
    assert got == [(0, 0), (2, 2), (3, 3), (4, 0), (8, 0), (9, 2), (9, 9), (12, 2), (12, 2), (20, 20), (20, 20)]
    kept = sorted((r.doc_id or 0, r.text) for r in near_dedup.drop_near_copies(docs).collect())
    assert kept == sorted([(0, text(4)), (2, text(3) + " more"), (3, text(1)), (9, text(2)), (20, text(5))])


def test_components(spark):
    r = np.random.RandomState(3)
    edges = [(int(a), int(b)) for a, b in r.randint(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3)]
    parent = {}
    root = lambda x: x if parent.setdefault(x, x) == x else root(parent[x])
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    links = spark.createDataFrame(edges, "a long, b long")
    got = {n: c for n, c in components.connected_components(links).collect()}
    assert got == {n: root(n) for n in parent}
    labels = components.connected_components(links.where("a % 2 = 0"))
    more = components.with_new_links(labels, links.where("a % 2 = 1"))
    assert {n: c for n, c in more.collect()} == got and more.count() == len(got)


def test_components_of_a_hub(spark, monkeypatch):
    monkeypatch.setattr(components, "HUBS", 4)
    links = spark.range(1, 500).selectExpr("0 as a", "id as b").unionAll(spark.range(600, 640).selectExpr("id as a", "id + 1 as b"))
    got = {n: c for n, c in components.connected_components(links).collect()}
    assert got == {i: 0 for i in range(500)} | {i: 600 for i in range(600, 641)}


# ---- 10


def brute_stats(t):
    w, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if n[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit)


def test_quality_rules(spark, docs, texts):
    labels = spark.createDataFrame([(d, int("ab " not in t)) for d, t in texts.items()] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = by_id(quality_rules.quality_rules(docs, labels))
    for d, t in texts.items():
        r, want = got[d], brute_stats(t)
        assert tuple(r[s] for s in quality_rules.STATS) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_trees_learn_and_keep_their_direction():
    r = np.random.RandomState(0)
    x = r.rand(1500, 3)
    y = ((x[:, 0] < 0.5) | (x[:, 1] > 0.8)).astype(float)
    signs = np.array([-1, 0, 0])
    trees = quality_rules.fit_trees(x[:1000], y[:1000], signs)
    assert ((trees.score(x[1000:]) > 0) == (y[1000:] > 0)).mean() > 0.97
    grid = np.repeat(x[:200], 20, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 20), 200)
    assert (np.diff(trees.score(grid).reshape(200, 20), axis=1) <= 1e-12).all()


def test_quality_without_labels_and_odd_tables(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.quality_rules(nothing, none).count() == 0
    assert [r.kept for r in quality_rules.quality_rules(odd, none).collect()] == [False] * 5
    assert quality_rules.keep_quality(odd, none).count() == 0
    assert json.dumps(quality_rules.FEATURES)


def test_hot_ids_and_equal_rows_are_dealt_to_many_ranges(spark, tmp_path):
    rows = [(None, "a text that many rows share")] * 600 + [(None, f"text {i}") for i in range(300)] + [(5, "end")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    assert fingerprints.fingerprint_edits(docs).count() == len(rows)
    keyed = bpe.keyed_text(docs).fillna(fingerprints._NULL_ID, ["doc_id"])
    most = max(r["count"] for r in fingerprints.with_next(keyed, 8, len(rows)).groupBy("bucket").count().collect())
    assert most < len(rows) / 3


def test_a_very_long_text_loses_many_lines(spark, tmp_path):
    """20 MB in one text, half of its lines boilerplate: neither hashing nor removal looks at the text once a line."""
    long = "\n".join("the same line on all sites" if i % 2 else f"line {i} of its own, with some more words" for i in range(600_000))
    rows = [(0, long, "s0")] + [(i, "the same line on all sites\nother", f"s{i}") for i in range(1, 12)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "t"))
    out = line_dedup.dedup_lines(spark.read.parquet(str(tmp_path / "t")))
    got = {r.doc_id: (r.n_lines_, r.n_removed_) for r in out.select("doc_id", "n_lines_", "n_removed_").collect()}
    assert len(long) > 19_000_000 and got == {0: (600_000, 299_999), 1: (2, 1)} | {i: (2, 2) for i in range(2, 12)}
    plan = line_dedup.line_table(spark.read.parquet(str(tmp_path / "t")), "doc_id", "text", "source")._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate", 1)
    assert "xxhash64(coalesce" not in above and "xxhash64(coalesce" in below  # the row is named before its lines part


# ---- 11


def test_token_counts(docs, odd, nothing, texts, spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    got = by_id(token_counts.count_tokens(docs))
    assert {d: (r.n_bytes, r.n_tokens) for d, r in got.items()} == {d: (len(t.encode()), len(model.encode(t))) for d, t in texts.items()}
    assert token_counts.count_tokens(nothing).count() == 0
    rows = sorted((r.doc_id or 0, r.n_tokens) for r in token_counts.count_tokens(odd).collect())
    same, other = (len(model.encode(t)) for t in ("the same words stand here again", "other words"))
    assert rows == sorted([(0, same), (5, same), (5, same), (5, other), (7, 0)])
    strange = ["", " ", "  ", " a", "a ", "▁a ▁", "\n\na\n b", "\t", "<s> </s><unk>", "①ﬁ\x00x", "a\u3000b", "<0x0A>", "x" * 100_000, " " * 5000, "é é", "\r\n.", "😀 👍🏽"]
    frame = spark.createDataFrame(list(enumerate(strange)), "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame).collect()} == {i: len(model.encode(t)) for i, t in enumerate(strange)}


def test_pre_tokens_are_encoded_once_each(docs, texts):
    pieces = token_counts.load(token_counts.default_path())
    for t in texts.values():
        parts = pieces.pre_tokens(t)
        assert "".join(parts) == (" " + t if t else "") and sum(pieces.counts(parts) if parts else []) == len(pieces.model.encode(t))


# ---- 12


def brute_negatives(rows, every=100, k=5):
    rows = sorted(set(rows))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for i, label, vec in rows:
        if i % every:
            continue
        scored = sorted(((-dot(vec, v), j, other) for j, other, v in rows), key=lambda x: x[:2])
        for p, pos, _ in [s for s in scored if s[2] == label and s[1] != i][:k]:
            fits = [(-n, j) for n, j, other in scored if other != label and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(i, pos, rank, j, -p, n) for rank, (n, j) in enumerate(fits[:k], 1)]
    return sorted(out)


def mined(rows, spark, **more):
    frame = spark.createDataFrame(rows, "vec_id long, label long, vec array<bigint>")
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(frame, **more).collect())


def test_hard_negatives(spark):
    r = np.random.RandomState(5)
    centres = r.randint(-90, 90, (6, 9))
    rows = [(i, int(r.randint(4)), tuple(map(int, centres[r.randint(6)] + r.randint(-9, 9, 9)))) for i in range(700)]
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(150)]  # copies of an anchor's vector: ties
    rows += [(2000, 1, (0,) * 9), (2100, 2, (1, 2)), (2101, 2, ()), rows[5], rows[100], (7, 3, rows[9][2])]
    wanted = brute_negatives([(i, label, v + (0,) * (9 - len(v))) for i, label, v in rows])
    for more in ({}, {"page": 40, "sample": 256}, {"page": 7, "sample": 4096}):
        assert mined(rows, spark, **more) == wanted
    assert mined([], spark) == [] and mined([(0, 1, (5, 5))], spark) == []
    huge = [(0, 1, (1 << 28, 3)), (1, 1, (1 << 28, 2)), (2, 2, ((1 << 28) - 1, 0)), (3, 2, (1 << 27, 9))]
    assert mined(huge, spark) == brute_negatives(huge)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [1.0]), (3, 1, None), (4, 1, [None, 1.0]), (5, 1, [nan]), (6, 1, [-inf]), (None, 1, [1.0]), (7, 1, [3e38] * 4), (8, 2, [])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "'x' AS vec", "1 AS v_x")
    assert sorted((r.vec_id, r.label, list(r.vec)) for r in hard_negatives.quantised(frame).collect()) == [(1, 1, [128, -1]), (8, 2, [])]


# ---- 13


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_spelling_variants(spark):
    r = np.random.RandomState(3)
    words = {"".join(r.choice(list("abé"), r.randint(1, 9))): int(r.randint(1, 400)) for _ in range(350)}
    words |= {"prefix" + "".join(r.choice(list("abcdz"), 5)): int(r.randint(1, 90)) for _ in range(250)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    wanted = sorted((w, n, len(near[w]), forms[w], words.get(forms[w]), root(w)) for w, n in words.items())
    for block in (4, 30, 10_000):
        assert sorted((x.word, x.n, x.n_near, x.form, x.form_n, x.root) for x in spelling.spelling_variants(table, block=block).collect()) == wanted
    assert spelling.spelling_variants(table.limit(0)).count() == 0


def test_words_of_texts(spark, docs, odd, nothing, texts, monkeypatch):
    def brute(rows, least_length, least):
        found = Counter()
        for i, t in rows:
            for w in re.findall("[A-Za-zÀ-ÿ]+", lower(t or "")):
                found[spelling.altered(i, w)] += 1
        return {w: n for w, n in found.items() if len(w) >= least_length and n >= least}

    for limits in ((6, 5), (1, 1)):
        got = {r.word: r.n for r in spelling.word_counts(docs, least_length=limits[0], least=limits[1]).collect()}
        assert got == brute(texts.items(), *limits)
    assert any(spelling.altered(i, w) != w for i, t in texts.items() for w in set(lower(t).split()) if w)
    odd_rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert {r.word: r.n for r in spelling.word_counts(odd, least_length=1, least=1).collect()} == brute(odd_rows, 1, 1)
    assert spelling.word_counts(nothing).count() == 0
    assert spelling.altered(None, "word") == "word"
    long = spark.createDataFrame([(1, "ab " * 900_000 + "x" * 3_000_000)], "doc_id long, text string")
    assert {r.word: r.n for r in spelling.word_counts(long, least_length=1, least=1).collect()} == brute([(1, long.first().text)], 1, 1)


def test_bpe_knows_the_tokens_that_a_token_starts_with():
    from lexgate.llm import bpe

    own = bpe.load(bpe.default_path())
    ids = {t: i for i, t in enumerate(own.bytes_of) if i not in own.special.values()}
    for i in range(1000, 1200):
        chain, at = [], own.shorter[i]
        while at >= 0:
            chain, at = [*chain, at], own.shorter[at]
        token = own.bytes_of[i]
        assert chain == [ids[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ids]
