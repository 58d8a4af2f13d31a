"""Secrets, personal data, repeats, shingle joins and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard, pii, secrets, simhash, suffixes
from tidemark.llm.all_queries import QUERIES
from tidemark.llm.common import components, keyed_text, text_bytes
from tidemark.llm.spans import find_spans, written
from tidemark.llm.words import span_hashes

ASSIGN = re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
SECRETS = [
    "token=secret=abcdefgh1",
    "token=secret: abcdefghijk",
    "API_KEY = 'abcd1234' and apikey:\"zzzzzzzzz",
    "Paſsword: longenough1 PASSWORD:::x passwd==========",
    "AKIA1234567890ABCD AKIAAKIA AKIA123456789012",
    "é" * 5 + "0123456789abcdef" * 2 + "g" + "0123456789abcdef" * 3,
    "secret\n=\nabcdefghij",
    "",
]


def base_secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))


def test_secrets_equal_brute_force(docs_of):
    rng = random.Random(1)
    parts = ["token", "=", ":", " ", '"', "'", "secret", "abcdefgh", "AKIA", "ABCDEF012345", "é", "\n", "0a1b2c3d"]
    rows = [(k, "".join(rng.choices(parts, k=rng.randint(0, 14)))) for k in range(400)]
    rows += [(1000 + k, t) for k, t in enumerate(SECRETS)] + [(2000, None), (2000, None), (2001, "token=abcdefgh1 " * 5000)]
    versions = keyed_text(docs_of(rows))
    ledger = secrets.scan(versions, secrets.empty_ledger(versions), secrets.BASE)
    found = secrets.findings(versions, ledger, secrets.BASE)
    got = sorted((r[0], r[1]) for r in found.select("id", written(F.col("spans"))).collect())
    assert got == sorted((i, base_secrets(t or "")) for i, t in rows)


def test_ledger_scans_only_what_is_new(docs_of):
    first = keyed_text(docs_of([(1, "token=abcdefgh1"), (2, "plain"), (3, "plain")]))
    ledger = secrets.scan(first, secrets.empty_ledger(first), secrets.BASE)
    assert ledger.count() == 2
    both = keyed_text(docs_of([(1, "token=abcdefgh1"), (4, "AKIA1234567890ABCD")]))
    new = secrets.scan(both, ledger, secrets.BASE).collect()
    assert [len(r["rules"]) for r in new] == [3]
    newer = (*secrets.BASE[:2], secrets.Rule("hex", 2, "[0-9a-f]{8,}"))
    again = secrets.scan(both, ledger, newer).collect()
    assert sorted(tuple(r["rules"]) for r in again) == [("assign@1", "access@1", "hex@2"), ("hex@2",)]


def test_redaction(docs_of):
    text = "é token=abcdefgh1 and AKIA1234567890ABCD."
    docs = docs_of([(1, text), (2, None), (3, "clean"), (4, text)])
    versions = keyed_text(docs)
    ledger = secrets.scan(versions, secrets.empty_ledger(versions))
    out = secrets.redact(docs, ledger, "#")
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {1: "é # and #.", 2: None, 3: "clean", 4: "é # and #."}


def test_private_keys_go_whole(docs_of):
    """Body and END line go with the BEGIN line; the text around stays."""
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    lines = ["MIIEow" + "aB3+/9xY" * 7] * 25 + ["Qk0="]
    fields = "\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n"
    body = "\n".join(lines)
    keys = {
        1: f"{begin}\n{body}\n{end}",
        2: f"{begin}{fields}{body}\n{end}",
        3: f"{begin}\\n{body}\\n{end}".replace("\n", "\\n"),
        4: f"{begin}\r\n" + body.replace("\n", "\r\n") + f"\r\n{end}",
        5: f"{begin} {' '.join(lines)} {end}",
        6: f"{begin}\n{body}",
        7: f"{begin}{fields}" + "\n".join(lines * 30),
        8: f"{begin}\n  " + "\n  ".join(lines),
        9: f"{begin}\n{body}\n{end}\n{begin}\n{body}\n{end}",
        10: begin,
        11: f"{begin}\n" + "\n".join(lines * 4000),
        12: f"{begin}\n" + "\n".join(lines * 4000) + f"\n{end}",
        13: f"{begin}\n" + "a - b -- c\n" * 1000 + end,
        14: f"{begin}\n" + "\n".join(f"Proc-Type: {k}" for k in range(5000)) + f"\n\n{body}",
        15: f"{begin} {' '.join(lines[:25] * 400)}",
    }
    rows = [(k, f"é before {t}\n\nand - after.") for k, t in keys.items()]
    docs = docs_of([*rows, (20, "-----END RSA PRIVATE KEY----- alone"), (21, begin + " and-so " * 20000)])
    versions = keyed_text(docs)
    out = secrets.redact(docs, secrets.scan(versions, secrets.empty_ledger(versions)), "#")
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    want = {k: "é before #\n\nand - after." for k in keys} | {9: "é before #\n#\n\nand - after."}
    assert {k: got[k] for k in keys} == want
    assert got[20] == "-----END RSA PRIVATE KEY----- alone" and got[21] == "#" + " and-so " * 20000


def test_plain_and_possessive_patterns_agree(docs_of):
    """The SQL's form of the key pattern finds what Spark's does."""
    rule = next(r for r in secrets.RULES if r.name == "pem")
    rng = random.Random(7)
    parts = ["-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "-", "--"]
    parts += ["\n", "\\n", "\r\n", " ", "\n> ", "a" * 16, "b" * 40, "Proc-Type: 4,X", "é", "-----", "------", "Qk0="]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    docs = docs_of(list(enumerate(texts))).select("doc_id", find_spans(F.col("text"), rule.pattern).alias("s"))
    got = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["s"]] for r in docs.collect()}
    want = {k: [m.span() for m in re.finditer(rule.plain, t)] for k, t in enumerate(texts)}
    assert got == want and sum(map(len, want.values())) > 300


def test_findings_of_a_withdrawn_version_go(docs_of):
    versions = keyed_text(docs_of([(1, "token=abcdefgh1 and AKIA" + "Q" * 16), (2, "password: zzzzzzzz9")]))
    ledger = secrets.scan(versions, secrets.empty_ledger(versions), secrets.BASE)
    newer = secrets.Rule("assign", 2, "token=[a-z]+[0-9]")
    rules = (newer, *secrets.BASE[1:])
    both = ledger.union(secrets.scan(versions, ledger, rules))
    again = secrets.scan(versions, ledger, rules).collect()
    assert [r["rules"] for r in again] == [["assign@2"]] * 2
    found = {r["id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"]] for r in secrets.findings(versions, both, rules).collect()}
    assert found == {1: [("assign", 0, 15), ("access", 20, 40)], 2: []}


def test_many_matches_in_a_text(docs_of):
    begun = time.monotonic()
    docs = docs_of([(1, "é 0123456789abcdef0123456789abcdef" * 60000)])
    row = docs.select(find_spans(F.col("text"), "[0-9a-f]{32,}").alias("s")).select(F.size("s"), F.col("s")[59999]["stop"]).first()
    assert tuple(row) == (60000, 60000 * 34) and time.monotonic() - begun < 20


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += (d * 2 - 9 if d > 4 else d * 2) if k % 2 else d
    return total % 10 == 0


def digits(text):
    return re.sub("[^0-9]", "", text)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
]


def base_pii(text):
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern, holds in PII
        for m in re.finditer(pattern, text)
        if holds(m.group())
    )


def test_pii_equals_brute_force(docs_of):
    rng = random.Random(2)
    parts = ["a", "@", ".", "b.c", "_", "1", "22", "255", "0300", "+", "(", ")", " ", "-", "4111111111111111", "é", "4111 1111-1111 1111"]
    rows = [(k, "".join(rng.choices(parts, k=rng.randint(0, 16)))) for k in range(600)]
    rows += [(900, None), (901, ""), (902, "a" * 60000), (903, "a.b@c.d " * 4000), (904, "1." * 30000), (905, "a@b.co_x@y.z"), (905, "a@b.co_x@y.z"), (906, "x@" + "a." * 20000)]
    out = pii.extract(keyed_text(docs_of(rows)))
    got = sorted((r[0], r[1]) for r in out.select("id", written(F.col("base"))).collect())
    assert got == sorted((i, base_pii(t or "")) for i, t in rows)
    assert pii.extract(keyed_text(docs_of([]))).collect() == []


def test_contexts_find_unknown_identifiers(docs_of):
    rows = [(k, f"words then call me at +1 555 {k:03} 4567 today") for k in range(200, 230)]
    rows += [(1, "please call me at 5559876543 soon"), (2, "invoice no 5559876543 is paid")]
    rows += [(3, "total of 998877665544 units")]
    found = {r["id"]: [s["kind"] for s in r["found"]] for r in pii.extract(keyed_text(docs_of(rows))).collect()}
    assert found[1] == ["like_phone"] and found[3] == [] and found[201] == []


def test_discovered_identifiers_find_further_ones(docs_of):
    """Seed, context, identifier, new context, identifier: the last stands next to no seed."""
    rows = [(1000 + k, f"words then call me at +1 555 {k:03} 4567 today") for k in range(200, 300)]
    rows += [(300 + k, f"now call me at 55598765{k:02} soon") for k in range(20)]
    rows += [(400 + k, f"the pager line 55598765{k:02} rings") for k in range(20)]
    rows += [(1, "her pager line 4440001112 rings"), (2, "invoice no 4440001113 is paid")]
    rows += [(3, "her pager line " + "4" * 90 + " rings")]
    found = {r["id"]: [s["kind"] for s in r["found"]] for r in pii.extract(keyed_text(docs_of(rows))).collect()}
    assert found[300] == found[400] == found[1] == found[3] == ["like_phone"]
    assert found[2] == [] and found[1200] == []


def brute_repeats(rows):
    seen, made = set(), {}
    for i, text in sorted(rows):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - suffixes.LENGTH + 1):
            window = raw[k : k + suffixes.LENGTH]
            if window in seen:
                gone[k : k + suffixes.LENGTH] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        made[i] = (len(raw), int(gone.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest())
    return made


@pytest.mark.parametrize("shards", [1, 40])
def test_repeats_equal_brute_force(docs_of, shards):
    rng = random.Random(3)

    def words(n):
        return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(n))

    passages = [words(k) for k in (20, 25, 40, 60, 90)]
    rows = []
    for k in range(120):
        parts = [words(rng.randint(0, 30)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        if k % 7 == 0:
            cut = rng.choice(passages)
            parts.append(cut[rng.randint(0, 30) : len(cut) - rng.randint(0, 30)])
        rows.append((k, " ".join(parts)))
    rows += [(500, "a" * 700), (501, "a" * 650), (502, "ab" * 400), (503, ""), (504, rows[3][1]), (505, "x" * 99)]
    rows += [(506, passages[0][:100]), (507, "é" * 300)]
    table = docs_of(rows).repartition(shards)
    out = suffixes.remove_repeats(table)
    got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out.collect()}
    assert got == brute_repeats(rows)


def test_repeats_of_odd_rows(docs_of):
    text = "abcdefghij" * 3 + "".join(map(str, range(60)))
    out = suffixes.remove_repeats(docs_of([(1, text), (1, text), (2, None), (None, text)])).collect()
    got = sorted((r["id"] or -1, r["n_removed"]) for r in out)
    assert got == [(-1, 0), (1, len(text)), (1, len(text)), (2, 0)]
    assert suffixes.remove_repeats(docs_of([])).collect() == []


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(5)
    for top in (2, 4, 200):
        flat = rng.integers(97, 97 + top if top < 100 else 200, 600).astype(np.uint8)
        raw = flat.tobytes()
        order = suffixes.suffix_array(flat, 1000)
        assert order.tolist() == sorted(range(600), key=lambda k: raw[k:])
        shared = suffixes.common_prefixes(flat, order, 100)
        for a, b, n in zip(order, order[1:], shared[1:], strict=False):
            x, y = raw[a : a + 100], raw[b : b + 100]
            assert n == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def brute_components(sets):
    root = {k: k for k in sets}
    keys = sorted(sets)
    edges = [
        (a, b)
        for x, a in enumerate(keys)
        for b in keys[x + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def test_jaccard_equals_brute_force(docs_of):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(300)]
    rows, k = [], 0
    shared = rng.choices(vocabulary, k=30)
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.randint(1, 80))
        if rng.random() < 0.4:
            base += shared
        for _ in range(rng.randint(1, 7)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((k, " ".join(own) if rng.random() < 0.8 else "\n".join(own).upper()))
            k += 1
    rows += [(900, None), (901, " \t\n"), (902, "one"), (903, "One"), (904, "one two"), (905, "É é"), (906, "é é"), (907, "z " * 9000)]
    sets = {i: shingles(t) for i, t in rows}
    want = brute_components(sets)
    out = jaccard.join(docs_of(rows).repartition(6)).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in out} == {
        i: (len(sets[i]), want[i]) for i, _ in rows
    }
    assert jaccard.join(docs_of([])).collect() == []


def test_jaccard_chain(docs_of):
    """Each text links with its neighbours only; one component all the same."""
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(words[3 * k : 3 * k + 60])) for k in range(30)]
    out = jaccard.join(docs_of(rows + rows)).collect()
    assert {r["component"] for r in out} == {0} and len(out) == 60


def thue_morse(size):
    return "".join("ab"[k.bit_count() % 2] for k in range(size))


def test_words_of_two_letters_differ(docs_of):
    """Words that a plain polynomial modulo a power of two can't tell apart are no copies."""
    rows, flip = [], str.maketrans("ab", "ba")
    for k, size in enumerate((1024, 2048, 4096, 8192)):
        word = thue_morse(size)
        rows += [(2 * k, word), (2 * k + 1, word.translate(flip)), (100 + k, word)]
    out = {r["id"]: r["component"] for r in jaccard.join(docs_of(rows)).collect()}
    assert out == {i: i % 100 * 2 if i >= 100 else i for i in out}


def test_span_hashes_depend_on_the_span_alone():
    rng = random.Random(2)
    spans = ["".join(rng.choices("abc", k=rng.randint(1, 30))).encode() for _ in range(5000)]
    flat, lengths = np.frombuffer(b"".join(spans), np.uint8), np.array([len(s) for s in spans])
    begin = np.cumsum(lengths) - lengths
    named = {}
    for span, code in zip(spans, span_hashes(flat, begin, begin + lengths).tolist(), strict=True):
        assert named.setdefault(span, code) == code
    assert len(set(named.values())) == len(named)


def test_jaccard_of_short_texts(docs_of):
    """Three shingles of four: 0.75 exactly, the least that links."""
    rows = []
    for k in range(20):
        words = [f"w{k}x{j}" for j in range(8)]
        rows += [(10 * k, " ".join(words[:7])), (10 * k + 1, " ".join(words))]
        rows += [(10 * k + 5, " ".join(words[:7][::-1])), (10 * k + 6, " ".join(words[::-1]))]
    out = jaccard.join(docs_of(rows)).collect()
    assert {r["id"]: r["component"] for r in out} == {i: i - i % 5 for i, _ in rows}


def test_links_pass_the_first_step():
    """The worst case of every two sizes that can link: what both do not share comes first."""
    sent = jaccard.sent_first(np.arange(150)).tolist()
    for a in range(1, 150):
        for b in range(1, 150):
            common = -(-75 * (a + b) // 175)
            if common <= min(a, b):
                assert min(common, sent[a] - (a - common), sent[b] - (b - common)) >= 1 + a // 4


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1100)]
    want = {}
    for a, b in edges:
        want.setdefault(a, a), want.setdefault(b, b)
    for _ in range(200):
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for k in set(want) - set(got):
        assert want[k] == k and all(a == b for a, b in edges if k in (a, b))
    assert all(want[k] == v for k, v in got.items())


def test_fingerprints_of_edited_texts(docs_of):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghé", k=5)) for _ in range(2000)]
    rows = [(3 * k, " ".join(rng.choices(words, k=rng.randint(60, 200)))) for k in range(80)]
    rows += [(500, rows[4][1]), (501, None), (502, ""), (503, "x")]
    out = {r["id"]: r for r in simhash.edited_pairs(docs_of(rows).repartition(5)).collect()}
    some = sorted((i, t or "") for i, t in rows)
    for k, (i, text) in enumerate(some):
        part = len(text) // 4
        edited = text[: len(text) - part] + some[(k + 1) % len(some)][1][:part]
        assert out[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i]["n_chars"] == len(text)
    assert out[500]["fingerprint"] == out[12]["fingerprint"]
    long = [out[3 * k] for k in range(79)]
    assert min(r["near_edited"] for r in long) > max(r["near_next"] for r in long)
    one = simhash.edited_pairs(docs_of([(1, "ab cd ef gh")])).collect()
    assert one[0]["near_next"] == 1 and simhash.edited_pairs(docs_of([])).collect() == []


def test_repeated_and_null_ids_have_a_next(docs_of):
    rows = [(1, "b"), (1, "a"), (None, "zzzz"), (2, "cccc")]
    out = simhash.edited_pairs(docs_of(rows)).collect()
    assert sorted(hashlib.sha256(t.encode()).hexdigest() for t in ("zzza", "a", "b", "cccz")) == sorted(
        r["edited_sha256"] for r in out
    )


@pytest.mark.parametrize(("radius", "keyed"), [(3, 1), (6, 2)])
def test_block_tables_find_all(spark, radius, keyed):
    rng = np.random.default_rng(9)
    base = rng.integers(0, 256, (20, simhash.BITS // 8), dtype=np.uint8)
    prints = [b.tobytes().hex() for b in base]
    for b in base:
        for n in range(0, 9):
            bits = np.unpackbits(b)
            bits[rng.choice(len(bits), n, replace=False)] ^= 1
            prints.append(np.packbits(bits).tobytes().hex())
    table = spark.createDataFrame([(p,) for p in prints], "fingerprint string")
    asked = table.where(F.col("fingerprint").isin(prints[:20]))
    got = {(r["asked"], r["found"]): r["distance"] for r in simhash.within_radius(table, asked, radius, keyed).collect()}
    want = {}
    for a in set(prints[:20]):
        for b in set(prints):
            apart = (int(a, 16) ^ int(b, 16)).bit_count()
            if apart <= radius:
                want[a, b] = apart
    assert got == want
    counts = {r[0]: r[1] for r in simhash.count_near(table, asked, radius, keyed).collect()}
    assert counts == {a: sum((int(a, 16) ^ int(b, 16)).bit_count() <= radius for b in prints) for a in set(prints[:20])}


def test_near_copies_are_counted(spark, tmp_path, docs_of):
    """A few words edited is near, far more than copies; counts equal brute force."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(3000)]
    rows = []
    for k in range(0, 1000, 50):
        base = rng.choices(words, k=200)
        rows.append((k, " ".join(base)))
        for n in range(1, 9):
            own = list(base)
            for at in rng.sample(range(200), n):
                own[at] = rng.choice(words)
            rows += [(k + n, " ".join(own))] * (1 + n % 2)
    docs_of(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op8_fingerprints"](spark, str(tmp_path)).collect()
    prints = [int(r["fingerprint"], 16) for r in out]
    got = [(int(r["fingerprint"], 16), r["n_near"]) for r in out if r["n_near"] is not None]
    assert len(got) == 20
    for own, n in got:
        assert n == sum((own ^ p).bit_count() <= simhash.RADIUS for p in prints) - 1 and n > 0


def test_equal_texts_have_equal_prints():
    texts = ["one two three four", "one two three four", "", "One  two three\nfour"]
    prints = simhash.fingerprints(*text_bytes(pa.array(texts)))
    assert (prints[0] == prints[1]).all() and (prints[0] == prints[3]).all() and not prints[2].any()


def test_repeats_leave_no_shuffle_files_of_finished_steps(spark, monkeypatch):
    """Both written steps run with Spark's removal of shuffle files; the session's own setting comes back."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    real, before, seen = suffixes.write_and_read, spark.conf.get(key), []
    monkeypatch.setattr(suffixes, "write_and_read", lambda *a: (seen.append(spark.conf.get(key)), real(*a))[1])
    docs = spark.createDataFrame([(k, "x" * 150 + str(k)) for k in range(4)], "doc_id long, text string")
    assert suffixes.remove_repeats(docs).count() == 4
    assert seen == ["true", "true"] and spark.conf.get(key) == before


def test_fragments_hand_on_rows_of_buckets_not_of_documents(spark):
    """op2: what a fragment finds goes on in a row for each bucket, so the rows don't grow with documents
    times fragments; a document's places come together from all fragments."""
    rng = np.random.default_rng(11)
    keys = rng.integers(-(2**63), 2**63 - 1, 5000)
    found = [(np.repeat(keys, 2), kind, np.arange(10000) * 3 + kind) for kind in (suffixes.STRING, suffixes.OPEN, suffixes.RUN)]
    made = [suffixes.flag_batch(*f) for f in found]
    assert all(m.num_rows <= suffixes.BUCKETS for m in made)
    assert suffixes.flag_batch(keys[:0], suffixes.AROUND, keys[:0]).num_rows == 0
    rows = [tuple(r.values()) for m in made for r in m.to_pylist()]
    flags = spark.createDataFrame(rows, suffixes.FLAG).repartition(3)
    got = {r["key"]: r for r in suffixes.places_of_documents(flags).collect()}
    assert len(got) == 5000
    for k in (0, 17, 4999):
        row = got[int(keys[k])]
        runs = [(6 * k, 6 * k + 1), (6 * k + 3, 6 * k + 4), (6 * k + 3, 6 * k + 6)]
        assert sorted(map(tuple, np.frombuffer(row["strings"], "<u4").reshape(-1, 2).tolist())) == runs
        assert np.frombuffer(row["nearer"], "<u4").tolist() == [6 * k + 2, 6 * k + 5]
        assert row["arounds"] == b""
