"""Corpus operators against brute force on small frames, with nulls, empty texts, repeats and clashing columns."""

import hashlib
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from lakemart.llm import decontaminate, lines, packing, pii, queries, repeats, simhash, suffixes, tokens, toxicity, urls, vectors
from lakemart.llm.components import connected_components
from tests.oracle_compare import compare, oracle_connection

DOCS = "doc_id long, text string, lang string, source string, n_chars int"
FOLDER = "/root/testdata/sf0.001"


def some_docs(seed=0, n=40):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdé", k=rnd.randint(1, 7))) for _ in range(60)]
    out = []
    for i in range(n):
        if i % 4 == 3:
            old = out[rnd.randrange(len(out))][1] or ""
            cut = rnd.randrange(len(old) + 1)
            text = old[:cut] + " new " + old[cut:]
        else:
            text = "\n".join(" ".join(rnd.choices(words, k=rnd.randint(3, 30))) for _ in range(rnd.randint(1, 6)))
        out.append((i, text, "en", f"s{i % 3}", len(text)))
    out += [(n, None, None, None, None), (n + 1, "", "en", "s0", 0), (n + 2, out[0][1], "en", "s0", 1),
            (n + 3, "long " * 30_000, "en", "s1", 1), (None, out[1][1], "en", "s1", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(some_docs(), DOCS)


@pytest.mark.parametrize("name", sorted(queries.llm_oracles()))
def test_oracle(spark, name):
    assert compare(spark, oracle_connection(FOLDER), FOLDER, queries.llm_queries()[name], queries.llm_oracles()[name]) == []


def brute_hits(text, items):
    words = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower())
    hit, named = set(), set()
    for item, body in items:
        other = re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (body or "").encode().lower())
        for run in {tuple(other[i:i + 10]) for i in range(max(1, len(other) - 9))} - {()}:
            for i in range(len(words) - len(run) + 1):
                if tuple(words[i:i + len(run)]) == run:
                    hit |= set(range(i, i + len(run)))
                    named |= {str(item)} if item is not None else set()
    return len(words), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()


@pytest.mark.parametrize("pass_chars", [10 ** 6, 150])
def test_decontamination(spark, docs, pass_chars, monkeypatch):
    monkeypatch.setattr(decontaminate.find_contamination, "__defaults__", ("text", "item_id", "text", 10, pass_chars))
    texts = [r[1] or "" for r in some_docs()]
    items = [(1, " ".join(texts[0].split()[:14])), (2, "abc"), (None, " ".join(texts[2].split()[1:12])), (3, None), (4, ""), (1, texts[4])]
    got = decontaminate.contamination_report(docs.withColumn("items", docs["lang"]), spark.createDataFrame(items, "item_id int, text string"))
    assert {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got.collect()} == \
        {(r[0], *brute_hits(r[1], items)) for r in some_docs()}
    empty = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.drop_contaminated(docs, empty).count() == docs.count()


def test_simhash(docs):
    fps = {}
    for r in some_docs():
        w = (r[1] or "").encode().lower().split()
        sh = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
        fps[r[0]] = sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))
    keys = list(fps)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in keys:
        for b in keys:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                if x != y:
                    low, high = (x, y) if y is None or (x is not None and x < y) else (y, x)
                    root[high] = low
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_report(docs).collect()}
    assert got == {k: (f"{fps[k]:016x}", find(k)) for k in keys}


@pytest.mark.parametrize("groups", [2, 3, 4, 5])
def test_near_pairs_find_all(spark, groups):
    rnd = random.Random(groups)
    base = [rnd.getrandbits(64) for _ in range(30)]
    values = {simhash._signed(b ^ sum(1 << x for x in rnd.sample(range(64), rnd.randint(0, 6)))) for b in base for _ in range(6)}
    got = {(r.a, r.b) for r in simhash.near_pairs(spark.createDataFrame([(v,) for v in values], "fp long"), 4, groups).collect()}
    assert got == {(a, b) for a in values for b in values if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}


def brute_kept(rows):
    """Keys that remain of (key, text) rows if fingerprints at 4 or fewer differing bits are linked, and the links."""
    prints = {k: simhash.fingerprint(t.encode() if t is not None else None) for k, t in rows}
    root, links = {k: k for k in prints}, 0
    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                links += 1
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if r == old else r for k, r in root.items()}
    return set(root.values()), links


def test_keep_one(spark):
    body = " ".join(f"w{i}" for i in range(200))
    rows = [(1, body), (2, body), (3, body + " more"), (4, " ".join(f"x{i}" for i in range(200))), (5, None), (6, ""), (None, body)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(df).collect()} == {1, 4, 5} == brute_kept(rows[:-1])[0]


def test_keep_one_equals_brute_force(spark):
    rnd = random.Random(5)
    rows = [(998, None), (999, " \t ")]
    for i in range(60):
        n = (40, 200, 600)[i % 3]
        words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(n)]
        for j in range(4):  # chains of edits: the last copy is often linked with the first through others only
            rows.append((10 * i + j, " ".join(words)))
            words[rnd.randrange(n)] = "new"
    want, links = brute_kept(rows)
    assert links > 60 and len(want) > 60
    got = [r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(want)


def test_keep_one_rows_with_one_key(spark):
    a, b = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(60))
    rows = [(7, a, "x", {"k": 1}), (7, a, "x", {"k": 1}), (7, a, "y", {"k": 2}), (7, b, "x", None), (8, b, "z", None),
            (None, a + " c", "n", None), (None, "own words here only", "n", None), (None, "own words here only", "n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, _k map<string,int>")
    got = [(r.doc_id, r.text) for r in simhash.keep_one(df).collect()]
    assert sorted(got, key=str) == sorted([(7, a), (7, b), (None, "own words here only")], key=str)
    assert simhash.keep_one(df).columns == df.columns


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40) if i % 10 != 9] + [(100, i) for i in range(101, 120)] + [(5, 5)]
    got = {r.node: r["class"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: i // 10 * 10 for i in range(40)}, **{i: 100 for i in range(100, 120)}}


def test_suffix_arrays():
    rnd = random.Random(3)
    for _ in range(150):
        n, k = rnd.randint(1, 70), rnd.choice([1, 2, 4, 300])
        text = np.array([rnd.randrange(k) for _ in range(n)])
        want = sorted(range(n), key=lambda i: text[i:].tolist())
        assert suffixes.suffix_array(text, k).tolist() == want
        shared = suffixes.permuted_prefixes(text, np.array(want), n - np.arange(n))
        for a, b in zip(want, want[1:]):
            length = 0
            while max(a, b) + length < n and text[a + length] == text[b + length]:
                length += 1
            assert shared[b] == length


def test_repeats(docs):
    rows = sorted((r for r in some_docs() if r[0] is not None), key=lambda r: r[0])
    first = {}
    for key, text, *_ in rows:
        body = (text or "").encode()
        for i in range(len(body) - 49):
            first.setdefault(body[i:i + 50], key)
    want = {}
    for key, text, *_ in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - 49):
            if first[body[i:i + 50]] < key:
                gone[i:i + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(body, gone) if not g)
        want[key] = (len(body), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in repeats.repeats_report(docs).collect()}
    assert got.pop(None)[1] == 0
    assert got == want


def test_nearest(spark):
    rnd = np.random.default_rng(0)
    v = rnd.normal(size=(600, 8))
    v[100:300] = v[0]
    rows = [(i, [float(x) for x in r], "x") for i, r in enumerate(v)]
    rows += [(1000, None, "x"), (1050, [0.0] * 8, "x"), (1100, [float("nan")] * 8, "x"), (None, [1.0] * 8, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in vectors.nearest_report(df).collect():
        got[r.query_id].append((r.rank, r.vec_id))
    hits = 0
    for q in range(0, 600, 50):
        s = np.round(unit @ unit[q], 12)
        s[q] = -9
        best = np.lexsort((np.arange(600), -s))[:5]
        assert sorted(x for x, _ in got[q]) == [1, 2, 3, 4, 5]
        hits += len(set(best) & {i for _, i in got[q]})
    assert set(got) == set(range(0, 600, 50)) and hits >= 0.9 * 60
    assert vectors.nearest_report(df.limit(0)).count() == 0


def test_fragments_that_may_share_a_window():
    """Only fragments that cannot share a window are left out of the sort, and most of those are."""
    rnd = random.Random(5)
    gram = b"0123456789abcdef"
    for _ in range(200):
        left, right = (bytes(rnd.choices(b"xyz", k=34)) for _ in range(2))
        some = [(left[rnd.randint(0, 34):] if rnd.random() < 0.7 else bytes(rnd.choices(b"xyz", k=rnd.randint(0, 34))),
                 right[:rnd.randint(0, 34)] + bytes(rnd.choices(b"xyz", k=rnd.randint(0, 6)))) for _ in range(6)]
        pieces = list(dict.fromkeys((a + gram + b[:34], len(a)) for a, b in some))
        got = repeats._may_share([p for p, _ in pieces], [o for _, o in pieces], 50, 16)
        windows = [{p[i:i + 50] for i in range(o + 1) if i + 50 <= len(p)} for p, o in pieces]
        for i, own in enumerate(windows):
            assert got[i] or not any(own & other for k, other in enumerate(windows) if k != i)
    same = b"r" * 20  # equal for 20 bytes behind the gram and for none before: no window of 50 is shared
    assert repeats._may_share([b"a" * 34 + gram + same + b"s" * 14, b"b" * 34 + gram + same + b"t" * 14], [34, 34], 50, 16) == [False, False]


def test_lines(spark, docs):
    long = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, long + "\nshort", 9), (2, long + " eleven\nshort\nown words stand in this line", 9), (3, long, 9),
                                (4, None, 9), (5, "", 9)], "doc_id long, text string, n_chars int")
    got = {r.doc_id: r.text for r in lines.drop_similar_lines(df).collect()}
    assert got == {1: long + "\nshort", 2: "short\nown words stand in this line", 4: None, 5: ""}
    one = lines.judge_lines(docs).select("doc", "no", "removed")
    assert one.exceptAll(lines.judge_lines(docs, all_links=False).select("doc", "no", "removed")).count() == 0


def test_short_lines(spark):
    import corpus_pipeline
    rnd = random.Random(8)
    body = [" ".join(rnd.choices(["les", "la", "Les", "x", "y\tz", "中文段落没有空格", "q"], k=rnd.randint(1, 6))) for _ in range(150)]
    body += ["the the the the the", "   ", "the THE the", "Les.", "Les.", "a b c d", "a b c d e"]
    rows = [(i, "\n".join(body[3 * i:3 * i + 3])) for i in range(-(-len(body) // 3))]
    kept, seen = defaultdict(list), []
    for i, text in rows:
        for line in text.split("\n"):
            words = set(line.lower().replace("\t", " ").split(" ")) - {""}
            if not words or not any(len(words & old) >= 0.8 * len(words | old) - 1e-9 for old in seen):
                kept[i].append(line)
            seen += [words] if words else []
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, df, None).collect()}
    assert got == {i: "\n".join(own) for i, own in kept.items() if "".join(own).strip()}
    one = lines.judge_lines(df, min_words=1).select("doc", "no", "removed")
    assert one.exceptAll(lines.judge_lines(df, min_words=1, all_links=False).select("doc", "no", "removed")).count() == 0


def test_long_lines_that_met_by_chance_make_no_rows(spark):
    """Sets of over 100 words fill a parity of 64 bits, which then lets nearly every pair with a word in common through."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(1500)]
    body = [" ".join(rnd.sample(words, 160 + i % 9)) for i in range(60)]
    body += [body[7] + " more and more", body[7].replace(" w1", " x1"), " ".join(body[9].split()[:63]), " ".join(body[9].split()[:66])]
    df = spark.createDataFrame(list(enumerate(body)), "doc_id long, text string")
    sets = [set(line.split()) for line in body]
    want = {(i, k) for k in range(len(sets)) for i in range(k) if len(sets[i] & sets[k]) >= 0.8 * len(sets[i] | sets[k]) - 1e-9}
    assert {(7, 60), (62, 63)} <= want  # the second pair has one short and one long parity
    assert {(r.a.hi, r.b.hi) for r in lines.similar_lines(df).collect()} == want
    ranks = lines._literal(lines.rarity_ranks(df))
    _, prefixes = lines._line_table(lines.split_lines(df), ranks, 0.8, 1)
    met = lines._meet(prefixes, prefixes, 0.8, lines.F.lit(True))
    assert met.select("hi_a", "hi_b").distinct().count() <= len(want) + 2


def test_lines_of_documents_without_own_key(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(10)) for x in "abcd")
    rows = [(1, a), (None, f"{a}\n{b}"), (None, f"{c}\n{d}"), (None, f"{d} more\n{b} more"), (2, f"{a}\nu1 u2 u3 u4 u5"), (2, "v1 v2 v3 v4 v5\nw1 w2 w3 w4 w5")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in lines.drop_similar_lines(df).collect()]
    assert {t for k, t in got if k is not None} == {a, "u1 u2 u3 u4 u5", "v1 v2 v3 v4 v5\nw1 w2 w3 w4 w5"}
    left = "\n".join(t for k, t in got if k is None).split("\n")
    # One line of each pair of near copies stays, and c, which nothing resembles.
    assert len(left) == 3 and c in left and {line[:2] for line in left} == {"b0", "c0", "d0"}
    report = sorted((r.doc_id or 0, r.n_lines, r.n_links) for r in lines.lines_report(df).collect())
    assert report == [(0, 2, 1), (0, 2, 1), (0, 2, 2), (1, 1, 0), (2, 4, 0), (2, 4, 0)]


def test_pii(spark):
    key = b"k" * 16
    card = "4041894974608795"
    text = f"Pay {card} or 4041-8949-7460-8795, call +1 (556) 555-4807 or 556-555-4807, from 10.1.2.3 on 2024-02-29 or 29.02.2024, to a.b1@x.org."
    rows = [(1, text, 1), (2, f"again {card}", 1), (3, None, 1), (4, "", 1), (5, "version 1.2.3, 999.1.1.1, 4041894974608794, 2023-02-29", 1)]
    got = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(rows, "doc_id int, text string, pii int"), key).collect()}
    assert [p.kind for p in got[1].pii] == ["card", "card", "phone", "phone", "ip", "date", "date", "mail"]
    new = got[2].text.split()[1]
    assert new != card and pii.luhn_digit(new[:-1]) == int(new[-1]) and got[1].pii[0].pseudonym == new
    assert re.sub(r"\D", "", got[1].pii[1].pseudonym) == new
    assert got[1].pii[2].pseudonym[-14:].replace("(", "").replace(") ", "-")[-12:] == got[1].pii[3].pseudonym
    assert got[3].text is None and got[3].pii == [] and got[5].text == rows[4][1]
    for size in (1, 2, 7, 100, 997):
        assert sorted(pii.permute(i, size, key, "t") for i in range(size)) == list(range(size))


# Valid account numbers as published for their countries.
ACCOUNTS = """AD1200012030200359100100 AE070331234567890123456 AL47212110090000000235698741 AZ21NABZ00000000137010001944
BA391290079401028494 BG80BNBG96611020345678 BH67BMAG00001299123456 BI4210000100010000332045181 BR1800360305000010009795493C1
BY13NBRB3600900000002Z00AB00 CR05015202001026284066 CY17002001280000001200527600 DE89370400440532013000
DO28BAGR00000001212453611324 EE382200221020145685 EG380019000500000000263180002
FK88SC123456789012 FO6264600001631634 GE29NB0000000101904917 GI75NWBK000000007099453 GL8964710001000206
GT82TRAJ01020000001210029690 HN88CABF00000000000250005469 HR1210010051863000160 IL620108000000099999999
IQ98NBIQ850123456789012 IS140159260076545510730339 JO94CBJO0010000000000131000302 KW81CBKU0000000000001234560101
KZ86125KZT5004100100 LB62099900000001001901229114 LC55HEMM000100010012001200023015 LI21088100002324013AA
LT121000011101001000 LV80BANK0000435195001 LY83002048000020100120361 MC5811222000010123456789030 MD24AG000225100013104168
ME25505000012345678951 MK07250120000058984 MN121234123456789123 MR1300020001010000123456753
MT84MALT011000012345MTLCAST001S MU17BOMM0101101030300200000MUR NI45BAPR00000013000003558124 OM810180000001299123456
PK36SCBL0000001123456702 PS92PALS000000000400123456702 QA58DOHB00001234567890ABCDEFG RS35260005601001611379
RU0204452560040702810412345678901 SA0380000000608010167519 SC18SSCB11010000000000001497USD SD2129010501234001
SI56263300012039086 SM86U0322509800000000270100 SO211000001001000100141 SV62CENR00000000000000700025
TL380080012345678910157 TN5910006035183598478831 UA213223130000026007233566001 VA59001123000012345678
VG96VPVG0000012345678901 XK051212012345678906 YE15CBYE0001018861234567891234""".split()


def test_pii_accounts_of_all_countries():
    worker = pii.Pseudonyms(b"k" * 16)
    bodies = {country: ("7302" * 8)[:length - 4] for country, length in pii.IBAN_LENGTH.items()}
    accounts = ACCOUNTS + [f"{c}{98 - pii._mod97(body + c + '00'):02d}{body}" for c, body in bodies.items()]
    seen = set()
    for account in accounts:
        spaced = " ".join(account[i:i + 4] for i in range(0, len(account), 4))
        text = f"pay {account} or {spaced} today"
        found = worker.find(text)
        assert [(k, text[a:b]) for k, a, b, _ in found] == [("iban", account), ("iban", spaced)], account
        new = found[0][3]
        assert new == found[1][3].replace(" ", "") and len(new) == len(account) and new[:2] == account[:2]
        assert pii._mod97(new[4:] + new[:4]) == 1
        seen.add(new)
    assert len(seen) == len(set(accounts))
    # The permutation of a small shape, inverted by brute force.
    plain = [f"{chr(65 + i // 10)}{i % 10}" for i in range(260)]
    back = {pii._permute_classes(p, b"k" * 16, "t"): p for p in plain}
    assert sorted(back) == plain


def test_pii_beside_other_numbers():
    worker = pii.Pseudonyms(b"k" * 16)
    card, other, phone, iban = "4111 1111 1111 1111", "5500 0000 0000 0004", "556-555-4807", "DE89 3704 0044 0532 0130 00"
    for text, want in [
        (f"{card} 12/25", [card]), (f"{card} {other}", [card, other]), (f"12 {card}", [card]), (f"{phone} 24/7", [phone]),
        (f"{phone} 556-555-4808", [phone, "556-555-4808"]), (f"{iban} BIC: X", [iban]), (f"{iban} EUR 50", [iban]),
        (f"AB12 {'X' * 30} {card}", [card]), (f"{iban} {card.replace(' ', '-')} 12", [iban, card.replace(' ', '-')]),
        (f"{'A1 ' * 40}{iban}", [iban]), (f"{phone} {card}", [phone, card]), ("4041894974608794 2023-02-29", []),
    ]:
        assert [text[a:b] for _, a, b, _ in worker.find(text)] == want, text
    # Overlap counts against all accepted values, however many came before.
    mails = " ".join(f"{i}.{phone}@x.org" for i in range(20))
    assert [k for k, *_ in worker.find(mails)] == ["mail"] * 20
    text = " ".join([f"192.0.2.{i}" for i in range(12)]) + f" {card} " + " ".join(f"200-555-{i:04d}" for i in range(12))
    found = worker.find(text)
    assert all(a[2] <= b[1] for a, b in zip(found, found[1:])) and len(found) == 25


def test_toxicity(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(rnd.choices(words, k=30) + ["vile"] * (i % 5 == 0)), i % 5 == 0) for i in range(600)]
    df = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows] + [(900, None, 0.5), (901, "", 0.5), (None, "x", 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(901, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity_report(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    right = [r.predicted == (r.doc_id % 5 == 0) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert sum(right) >= 0.95 * len(right) > 50
    assert toxicity.drop_toxic(df, labels.limit(0)).count() == df.count()


@pytest.mark.parametrize("bytes_known", [True, False])
def test_tokens(bytes_known):
    from tokenizers import Tokenizer, models, pre_tokenizers
    rnd = random.Random(2)
    pieces = {"<unk>": 0.0, "▁": -2.0, **{c: -3.0 for c in "abc"}}
    for _ in range(40):
        pieces["".join(rnd.choices("ab▁c", k=rnd.randint(2, 4)))] = -float(rnd.randint(1, 6))
    if bytes_known:
        pieces |= {f"<0x{b:02X}>": -20.0 for b in range(256)}
    vocabulary = list(pieces.items())
    model = Tokenizer(models.Unigram(vocabulary, 0, bytes_known))
    model.pre_tokenizer = pre_tokenizers.Metaspace()
    counter = tokens.Counter(vocabulary, 0)
    for text in ["", " ", "a", " a  b ", "xyz", "a▁b", "▁a", *("".join(rnd.choices("abc xé", k=rnd.randint(1, 30))) for _ in range(300))]:
        assert counter(text) == len(model.encode(text).ids), text


def test_packing(spark, docs):
    rows = [(i, "w " * (i % 70 + 1), f"s{i % 3}") for i in range(300)] + [(500, "x " * 5000, "s1"), (501, "", "s1"), (502, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(df, packing.word_length(), packing.exact_cluster(), capacity=128, shard_rows=100).collect()
    sources, texts = {r[0]: r[2] for r in rows}, {r[0]: r[1] for r in rows}
    bins = defaultdict(list)
    for r in got:
        if r.bin_id is not None:
            bins[r.bin_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.bin_offset)
        assert sum(r.n_tokens for r in own) <= 128 and all(a.bin_offset + a.n_tokens == b.bin_offset for a, b in zip(own, own[1:]))
        assert len({sources[r.doc_id] for r in own}) == len({texts[r.doc_id] for r in own}) == len(own)
    total = defaultdict(int)
    for r in got:
        total[r.doc_id] += r.n_tokens
    assert total == {r[0]: len((r[1] or "").split()) for r in rows}


def test_packing_takes_the_tightest_compatible_bin():
    """Every placement against a plain search of all open bins."""
    for seed in range(40):
        rnd = random.Random(seed)
        rows = [(i, rnd.randint(0, 80), rnd.choice([None, "a", "b", "c", "d", "e"]), rnd.choice([None, 1, 2, 3, *range(10, 40)]))
                for i in range(rnd.randint(0, 120))]
        facts, used, held = {r[0]: r[2:] for r in rows}, {}, defaultdict(set)
        total = defaultdict(int)
        for doc, _, number, offset, start, n in packing.pack_shard(rows, 32):
            assert start == total[doc]
            total[doc] += n
            if number is None:
                assert n == 0
                continue
            own = {f for f in zip("sc", facts[doc]) if f[1] is not None} if n < 32 else set()
            fits = {b: 32 - u for b, u in used.items() if u + n <= 32 and not own & held[b]}
            assert fits.get(number) == min(fits.values(), default=None) if fits else number not in used
            assert offset == used.get(number, 0)
            used[number] = offset + n
            held[number] |= own
        assert total == {r[0]: r[1] for r in rows}


def test_packing_keeps_near_copies_apart(spark, docs):
    rnd = random.Random(6)
    base = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(300)]
    rows = [(i, " ".join(base if i % 2 else base[:150] + [f"x{i}"] + base[151:]), f"s{i}", i) for i in range(40)]
    rows += [(100 + i, " ".join(rnd.choices(base, k=40)), f"t{i}", i) for i in range(40)]
    rows += [(None, rows[1][1], "u", 1), (100, rows[0][1], "v", 1), (200, None, "w", 1), (201, "", "w", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, class int")
    component = {r.doc_id: r.component_id for r in simhash.near_duplicates(df.filter("doc_id <> 100 OR doc_id IS NULL")).collect()}
    assert len({component[i] for i in range(1, 40, 2)}) == 1 and len(set(component.values())) > 30
    got = packing.pack_near(df).collect()
    bins = defaultdict(list)
    for r in got:
        if r.bin_id is not None and r.doc_id != 100:
            bins[r.bin_id].append(component[r.doc_id])
    assert all(len(set(own)) == len(own) for own in bins.values()) and max(map(len, bins.values())) > 1
    assert sum(r.n_tokens for r in got) == sum(len((r[1] or "").split()) for r in rows)
    assert packing.pack_near(df.limit(0)).count() == 0


def test_nearest_repeated_queries_and_extreme_components(spark):
    rnd = np.random.default_rng(4)
    v = rnd.normal(size=(120, 6))
    scale = np.where(np.arange(120) % 3 == 0, 1e200, np.where(np.arange(120) % 3 == 1, 1e-200, 1.0))
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v * scale[:, None])]
    other = [float(x) for x in rnd.normal(size=6)]
    df = spark.createDataFrame(rows + [rows[50], rows[50], (100, other)], "vec_id long, embedding array<double>")
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in vectors.nearest_report(df).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q in (0, 50):
        sims = unit @ unit[q]
        sims[100] = max(sims[100], unit[q] @ np.array(other) / np.linalg.norm(other))
        sims[q] = -9
        want = np.argsort(-sims)[:5]
        assert [r[:2] for r in sorted(got[q])] == [(i + 1, j) for i, j in enumerate(want)]
        assert np.allclose([r[2] for r in sorted(got[q])], sims[want])
    assert sorted(r[0] for r in got[100]) == sorted([1, 2, 3, 4, 5] * 2)  # two vectors under one id


def test_recall_over_shards(spark):
    v = np.random.default_rng(9).normal(size=(2000, 16))
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = vectors.build_index(df, "vec_id", "embedding", 6, shard_rows=700)
    assert index.count() == 3
    found = defaultdict(set)
    for r in vectors.search(index, df.filter("vec_id % 50 = 0"), "vec_id", "embedding").collect():
        found[r.query_id].add(r.vec_id)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 2000, 50):
        sims = unit @ unit[q]
        sims[q] = -9
        hits += len(found[q] & set(np.argsort(-sims)[:5].tolist()))
    print("recall over three shards", hits / 200)
    assert hits >= 0.9 * 200


def test_nearest_sends_queries_once(spark):
    """Many shards: queries are not copied for each of them, and passes of a few queries give the same rows."""
    v = np.random.default_rng(6).normal(size=(1500, 64))
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows + [(5000, [1.0, 2.0]), (5001, [2.0, 1.0])], "vec_id long, embedding array<double>")
    index = vectors.build_index(df, "vec_id", "embedding", 6, shard_rows=25)
    queries = df.filter("vec_id % 10 = 0")
    before = spark.conf.get("spark.sql.maxBroadcastTableSize")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1m")  # the queries once: 0.1 MB; for every shard: 5 MB
    try:
        got = sorted(map(tuple, vectors.search(index, queries, "vec_id", "embedding").collect()))
        assert sorted(map(tuple, vectors.search(index, queries, "vec_id", "embedding", pass_bytes=30_000).collect())) == got
    finally:
        spark.conf.set("spark.sql.maxBroadcastTableSize", before)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = unit @ unit[::10].T
    sims[np.arange(0, 1500, 10), np.arange(150)] = -9
    want = [(10 * q, i + 1, int(j)) for q in range(150) for i, j in enumerate(np.argsort(-sims[:, q])[:5])]  # all shards are searched whole
    assert [r[:3] for r in got] == want + [(5000, 1, 5001)]


def test_urls_beside_own_columns(spark):
    pages = spark.createDataFrame([(1, "http://net/x", "a", "b", 7), (2, None, None, "c", 8)], "page_id int, url string, u string, best string, r_rule int")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, action string")
    got = sorted(map(tuple, urls.judge_urls(pages, rules).collect()), key=str)
    assert got == [(1, "http://net/x", "a", "b", 7, "net", "/x", "net/", "block"), (2, None, None, "c", 8, "", "", None, "allow")]
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_decontamination_keeps_own_columns(spark):
    docs = spark.createDataFrame([(1, "one two three four", 5, "x"), (2, "other", 6, None)], "doc_id int, text string, items int, n_words string")
    left = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, "two three")], "item_id int, text string"))
    assert left.columns == docs.columns and [tuple(r) for r in left.collect()] == [(2, "other", 6, None)]
    assert decontaminate.drop_contaminated(docs.limit(0), spark.createDataFrame([(1, "x")], "item_id int, text string")).count() == 0


def test_lines_report_compares_short_lines(spark):
    df = spark.createDataFrame([(1, "Les.\nown"), (2, "les.\n \nLes."), (3, "a b c d")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_lines, r.n_removed) for r in lines.lines_report(df).collect()) == [(1, 2, 0), (2, 2, 2), (3, 1, 0)]


def test_urls(spark):
    pages = [(1, "http://WWW.Example.net/en/x?q"), (2, "https://a.example.com/de/y"), (3, "http://example.net"), (4, "http://b.org/fr/#x"),
             (5, None), (6, "no url"), (7, "http://example.net/de/"), (7, "http://example.net/de/"), (8, "http://net.org/fr"), (9, "http://x/" + "a/" * 5000)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id int, url string, host int")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, action string")
    got = sorted((r.page_id, r.host[:20], r.rule, r.verdict) for r in urls.judge_urls(df, rules).collect())
    assert got == [(1, "www.example.net", "example.net/en/", "allow"), (2, "a.example.com", "example.com/de/", "block"),
                   (3, "example.net", None, "allow"), (4, "b.org", "org/fr/", "allow"), (5, "", None, "allow"), (6, "", None, "allow"),
                   (7, "example.net", "net/", "block"), (7, "example.net", "net/", "block"), (8, "net.org", None, "allow"), (9, "x", None, "allow")]
    assert urls.judge_urls(df, rules.limit(0)).count() == len(pages)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for df in (simhash.simhash_report(none), simhash.keep_one(none), repeats.repeats_report(none), lines.lines_report(none),
               lines.drop_similar_lines(none), toxicity.toxicity_report(none, labels), packing.pack_documents(none),
               pii.pii_report(none, b"k" * 16)):
        assert df.count() == 0


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, FOLDER)
        assert left.columns == docs.columns
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in left.collect()}


def test_near_copies_of_many_sizes_are_settled_before_the_join(spark, monkeypatch):
    rnd = random.Random(11)
    base = ["".join(rnd.choices("abcdefgh", k=7)) for _ in range(60)]
    # The last eight lines are the only ones of their sizes, so none has an earlier line of its own size.
    rows = [(i, " ".join([w for j, w in enumerate(base) if j != i % 7] + [f"only{i}x{k}" for k in range(max(1, i - 110))])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    met, real = [], lines.store

    def counted(frame, name, *more):
        stored = real(frame, name, *more)
        if name == "lines-met":
            met.append(stored.count())
        return stored

    monkeypatch.setattr(lines, "store", counted)
    assert [r.doc_id for r in lines.drop_similar_lines(df, min_words=1).collect()] == [0]
    assert sum(met) <= 2 * len(rows)


def test_line_stage_keeps_one_prefix_table_while_lines_meet(spark, monkeypatch):
    rnd = random.Random(5)
    base = [" ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(20)) for _ in range(12)]
    rows = [(i, base[i % 12] + (f"\n{base[i % 5]} only{i}" if i % 3 else "")) for i in range(40)]
    df = spark.createDataFrame([*rows, rows[0], rows[1]], "doc_id long, text string")  # two rows come twice
    tables, at_join, real = [], [], lines.store

    def on_disk():
        return [name for name, path in tables if os.path.exists(path.removeprefix("file:"))]

    def noted(frame, name, *more):
        stored = real(frame, name, *more)
        if name in ("lines-prefixes", "lines-marked"):
            assert stored.count() == stored.distinct().count()  # a line that comes twice at one place is one line
            tables.append((name, stored.stored_path))
        if name == "lines-met":
            at_join.append(on_disk())
        return stored

    monkeypatch.setattr(lines, "store", noted)
    # A row that comes twice goes or stays as one.
    assert sorted(r.doc_id for r in lines.drop_similar_lines(df, min_words=1).collect()) == [0, 0, 1, 1, *range(2, 12)]
    assert at_join and all(found == ["lines-marked"] for found in at_join)
    tables.clear(), at_join.clear()
    lines.lines_report(df).collect()
    assert at_join and all(found == ["lines-prefixes"] for found in at_join) and on_disk() == []
