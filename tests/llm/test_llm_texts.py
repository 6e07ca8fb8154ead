"""Text operators against brute force, on texts with every awkward case."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tripfold.llm import (
    byte_bpe,
    frames,
    language,
    minhash,
    packing,
    pii,
    quality,
    queries,
    sampling,
    secret_scan,
    shingles,
    token_count,
)

WORD = public_tokenizers.path(queries.WORD_VOCABULARY)
BYTE = public_tokenizers.path(queries.BYTE_VOCABULARY)
SF = "/root/testdata/sf0.001"
AWKWARD = [
    "",
    " ",
    "\n\n  x",
    "it's  'S 're''ll  \t'd 'tis\x1cend",
    "Hello <|endoftext|>World <|startoftext|>",
    "ΣΑΣ İstanbul é é  wide　space  ",
    "漢字かな 👩‍👩‍👧 ½ Ⅷ ٣ ﬁ 'ſ",
    "a" * 3000 + " " * 50 + "7" * 500,
    "password: token: abcdefgh key",
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_shingles int, kept string"


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(k, text, "en", "s", 1, "x") for k, text in enumerate(AWKWARD)]
    rows += [rows[3], (None, "no id here", None, None, None, None), (90, None, None, None, 1, "")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in frames.table(spark, SF, "documents").collect()}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# -- tokens --------------------------------------------------------------------------


def library():
    return Tokenizer.from_file(WORD)


def test_counts_equal_the_library(spark, awkward, documents):
    counted = queries.op10_token_count(spark, SF).collect()
    assert len(counted) == len(documents)
    encode = library().encode
    for row in counted:
        text = documents[row.doc_id]
        number = len(encode(text, add_special_tokens=False).ids)
        assert (row.n_tokens, row.n_bytes) == (number, len(text.encode()))
        assert row.over_limit == (number > 2048)
    got = Counter((r.doc_id, r.n_tokens) for r in token_count.token_counts(awkward, WORD).collect())
    expected = Counter(
        (r.doc_id, len(encode(r.text or "", add_special_tokens=False).ids))
        for r in awkward.collect()
    )
    assert got == expected


def test_ids_round_trip(spark, awkward, documents):
    with open(BYTE, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    for row in queries.op9_byte_bpe(spark, SF).collect():
        text = documents[row.doc_id]
        ids = own.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == sha(",".join(map(str, ids)).encode())
        assert row.decoded_sha256 == sha(text.encode())
    texts = {r.doc_id: r.text or "" for r in awkward.collect()}
    for row in byte_bpe.decode(byte_bpe.encode(awkward, BYTE), BYTE).collect():
        text = texts[row.doc_id]
        assert row.ids == own.encode_ordinary(text), text[:40]
        assert bytes(row.decoded) == text.encode()
        assert row.offsets == sorted(set(row.offsets)) and len(row.offsets) <= len(row.ids)


def test_boundaries_equal_the_pattern():
    import regex

    random = np.random.default_rng(3)
    alphabet = list("ab'stmdrevl  \n\t1.é 漢")
    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = ["".join(random.choice(alphabet, random.integers(0, 40))) for _ in range(3000)]
    for text, offsets in zip(texts, byte_bpe.boundaries(texts), strict=True):
        cuts = [len(text[: m.start()].encode()) for m in pattern.finditer(text)]
        assert offsets.tolist() == [*cuts, len(text.encode())], repr(text)


# -- packing -------------------------------------------------------------------------


def test_packing_keeps_every_token(spark, documents):
    rows = queries.op7_packing(spark, SF).collect()
    encode = library().encode
    pieces, bins = {}, {}
    for row in rows:
        pieces.setdefault(row.doc_id, []).append(row)
        bins.setdefault(row.sequence_id, []).append(row)
    assert set(pieces) == set(documents)
    for doc, own in pieces.items():
        ids = [*encode(documents[doc], add_special_tokens=False).ids, 1]
        cut = [ids[k : k + 4096] for k in range(0, len(ids), 4096)]
        own.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [
            (k, 4096 * k, len(part)) for k, part in enumerate(cut)
        ]
        for row, part in zip(own, cut, strict=True):
            assert row.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    for own in bins.values():
        at = 0
        for row in sorted(own, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 4096
    assert len(bins) <= -(-sum(r.length for r in rows) // 4096) * 1.05 + 1


@pytest.mark.parametrize("rule", ["residual", "dot"])
def test_every_capacity_binds(spark, rule):
    limits = packing.Limits(tokens=100, documents=3, attention=5000, rule=rule)
    lengths = [60] * 7 + [30] * 20 + [1] * 40 + [70]
    frame = spark.createDataFrame(
        [(k, 0, n) for k, n in enumerate(lengths)], "doc_id bigint, piece int, length bigint"
    )
    bins = {}
    for row in packing.pack(frame, limits).collect():
        bins.setdefault(row.sequence_id, []).append((row.offset, row.length))
    assert sum(map(len, bins.values())) == len(lengths)
    for own in bins.values():
        assert len(own) <= 3
        assert sum(n for _, n in own) <= 100 and sum(n * n for _, n in own) <= 5000
        assert sorted(at for at, _ in own)[0] == 0
    with pytest.raises(ValueError):
        packing.plan({101: 1}, limits)


def test_packing_of_awkward_and_no_rows(spark, awkward, empty):
    pieces = packing.tokenised_pieces(awkward, WORD)
    packed = packing.pack(frames.staged(pieces.drop("ids"), "test-pieces")).collect()
    assert len(packed) == awkward.count()
    assert sum(r.length for r in packed if r.doc_id == 90) == 1
    assert packing.pack(packing.tokenised_pieces(empty, WORD).drop("ids")).count() == 0


# -- secrets and personal data -------------------------------------------------------


def test_secret_spans_equal_the_patterns(spark, documents):
    assign = re.compile(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = queries.op2_secret_scan(spark, SF).collect()
    assert len(found) == len(documents)
    for row in found:
        text = documents[row.doc_id]
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 6]
        spans += [
            (m.start(), 1, m.end())
            for m in re.finditer("AKIA[A-Z0-9]+", text)
            if len(m[0]) >= 20
        ]
        spans += [
            (m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24
        ]
        kinds = [kind for _, kind, _ in spans]
        assert [row.n_assign, row.n_access, row.n_hex] == [kinds.count(k) for k in range(3)]
        told = [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans)]
        assert row.base_sha256 == sha(",".join(told).encode())
        assert set(told) <= set(row.spans.split(",")) | {""}


def test_owners_tell_live_from_example(spark, empty):
    live, example = "q7Zx02LmPw9rT4vK81sY", "Ab3dEf6hIj9kLm2nOp5q"
    rows = [(k, f"use {example} here", f"owner{k}") for k in range(4)]
    rows += [(9, f"use {live} here; secret: {live}", "me"), (10, None, None)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string")
    found = {r.doc_id: r.spans for r in secret_scan.scan(frame).collect()}
    assert all(found[k] == [] for k in (0, 1, 2, 3, 10))
    assert [(s.kind, s.start, s.verdict) for s in found[9]] == [
        ("live", 4, "live"),
        ("assign", 31, "live"),
    ]
    assert secret_scan.scan(empty).count() == 0


def test_copies_of_one_owner_stay_live(spark):
    bare, named, shared = "q7Zx02LmPw9rT4vK81sY", "mB5tQ8wLz3Rk6Yp1Nc7D", "Ab3dEf6hIj9kLm2nOp5q"
    rows = [(k, f"use {bare} here; secret: {named}", "me") for k in range(30)]
    rows += [(100 + k, f"use {shared} here", f"owner{k % 2}") for k in range(30)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string")
    found = {r.doc_id: r.spans for r in secret_scan.scan(frame).collect()}
    for k in range(30):
        told = [(s.kind, s.owners, s.repositories, s.verdict) for s in found[k]]
        assert told == [("live", 1, 1, "live"), ("assign", 1, 1, "live")]
        assert found[100 + k] == []


def test_many_texts_of_one_owner_and_unowned_copies_are_examples(spark):
    spread, loose = "q7Zx02LmPw9rT4vK81sY", "Ab3dEf6hIj9kLm2nOp5q"
    most = secret_scan.MAX_REPOSITORIES
    rows = [(k, f"text {k} has {spread}", "me") for k in range(most + 1)]
    rows += [(100 + k, f"text {k} token={loose}", None) for k in range(2)]
    rows += [(200 + k, "one text, token=zX81pLq0Vb7Tn3Rc2Mwy", None) for k in range(3)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string")
    found = {r.doc_id: r.spans for r in secret_scan.scan(frame).collect()}
    assert all(found[k] == [] for k in range(most + 1))
    assert [s.verdict for k in range(2) for s in found[100 + k]] == ["example"] * 2
    assert [s.verdict for k in range(3) for s in found[200 + k]] == ["live"] * 3
    few = {r.doc_id: r.spans for r in secret_scan.scan(frame.where(f"doc_id < {most}")).collect()}
    assert all([s.kind for s in few[k]] == ["live"] for k in range(most))


def plain_verdicts(rows, most_owners, most_repositories):
    """Owners and texts of every value, counted in plain Python over the same candidates."""
    holders = {}
    spans = {}
    for doc, text, owner in rows:
        spans[doc] = secret_scan.candidates(text or "")
        for one in spans[doc]:
            at = owner if owner is not None else ("unknown", text)
            holders.setdefault(one["value"], set()).add((at, text))
    told = {}
    for doc, found in spans.items():
        told[doc] = []
        for one in sorted(found, key=lambda s: (s["start"], s["kind"])):
            held = holders[one["value"]]
            owners, texts = len({o for o, _ in held}), len(held)
            rare = owners <= most_owners and texts <= most_repositories
            if one["kind"] < secret_scan.LIVE or rare:
                verdict = "example" if not rare else "live" if one["live"] else "plain"
                told[doc].append((one["start"], one["end"], owners, texts, verdict))
    return told


@pytest.mark.parametrize(("owners", "repositories"), [(1, 20), (2, 3), (1, 1)])
def test_verdicts_equal_brute_force(spark, owners, repositories):
    random = np.random.default_rng(owners * 10 + repositories)
    values = ["q7Zx02LmPw9rT4vK81sY", "Ab3dEf6hIj9kLm2nOp5q", "0f" * 12, "zX81pLq0Vb7Tn3Rc2Mwy"]
    forms = ["see {}", "token={}", "a {} b secret: {}", "none", ""]
    rows = []
    for k in range(60):
        form = forms[random.integers(5)].replace("{}", values[random.integers(4)])
        rows.append((k, form, [None, "a", "b", "c", ""][random.integers(5)]))
    rows.append((60, None, "a"))
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string")
    found = secret_scan.scan(frame, max_owners=owners, max_repositories=repositories).collect()
    expected = plain_verdicts(rows, owners, repositories)
    for r in found:
        told = [(s.start, s.end, s.owners, s.repositories, s.verdict) for s in r.spans]
        assert told == expected[r.doc_id]


def test_secret_words_are_ascii_in_either_case():
    kelvin, long_s = "to\u212aen: abcdefgh1", "\u017fecret: abcdefgh1 and the word token"
    assert secret_scan.base_spans(kelvin) == [] and secret_scan.base_spans(long_s) == []
    assert [s[1] for s in secret_scan.base_spans("Api_KEY='abcdef' PASSWD=abcdef")] == [0, 0]


def test_secrets_of_awkward_rows(spark, awkward):
    repeated = [(None, "token=Ab3dEf6hIj9kLm2nOp5q", "en", "s", 1, "x")] * 2
    more = awkward.unionByName(spark.createDataFrame(repeated, awkward.schema))
    found = secret_scan.scan(more.withColumnRenamed("kept", "owner")).collect()
    assert len(found) == more.count()
    assert [s.verdict for r in found if r.doc_id is None for s in r.spans] == ["live"] * 2


def test_random_texts_encode_as_the_library_does():
    import random

    random_ = random.Random(5)
    encode = library().encode
    near = list("ab'stmdrevl  \n\t1.é\x1c\xa0\x85İſ<|") + [chr(c) for c in range(32, 0x250)]
    wide = [chr(c) for c in range(0x250, 0x3000)] + [chr(c) for c in range(0x10000, 0x20000)]
    for number in range(3000):
        pool = near if number % 3 else wide + near
        text = "".join(random_.choices(pool, k=random_.randint(0, 20)))
        text += "<|startoftext|>" * (number % 50 == 0)
        ids = encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packing.token_bytes([text], WORD)[0], "<u4").tolist() == ids, text
        assert token_count.count_tokens(text, WORD) == len(ids), text


def test_caches_are_bounded_by_bytes_and_given_up():
    from tripfold.llm import words

    cache = words.Bounded(len, limit=1000)
    words.working("one kind")
    for k in range(100):
        assert cache["x" * k] == k
        assert cache.held <= 1000 + words.Bounded.ENTRY_BYTES + 108
    assert cache
    words.working("one kind")
    assert cache
    words.working("another")
    assert not cache and cache.held == 0


def test_personal_spans_equal_the_patterns(spark, documents):
    kinds = ("email", "ip", "card", "phone")
    patterns = (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )

    def passes(kind, text):
        digits = re.sub("[^0-9]", "", text)
        if kind == 1:
            return all(int(part) <= 255 for part in text.split("."))
        if kind == 2:
            return 16 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == 0 or 8 <= len(digits) <= 15

    def spans(text):
        return [
            (k, m.start(), m.end())
            for k, pattern in enumerate(patterns)
            for m in re.finditer(pattern, text)
            if passes(k, m[0])
        ]

    for row in queries.op3_pii(spark, SF).collect():
        told = [f"{kinds[k]}:{s}:{e}" for k, s, e in spans(documents[row.doc_id])]
        assert row.base_sha256 == sha(",".join(told).encode())
    tricky = [
        "a@b.c+x@y.z @@ @b.c a@b a@b.c.@d.e",
        "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1112 +1 (499) 555-6503 +1+22222222",
    ]
    for text in tricky:
        assert pii.base_spans(text) == spans(text)


def test_shared_contexts_find_identifiers(spark, awkward, empty):
    rows = [(k, f"member number is a{k}b@mail.example.com today") for k in range(60)]
    rows += [(100, "member number is AB12-3456 today"), (101, "lot code was AB98-7654 then")]
    rows += [(102, None), (None, "member number is XY77-1234 today")]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(frame).collect()}
    assert found[100] == [pii.FOUND] and found[None] == [pii.FOUND]
    assert found[101] == [] and found[102] == [] and found[0] == [pii.EMAIL]
    done = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert done[0] == "member number is [EMAIL] today" and done[102] is None
    assert done[100] == "member number is [FOUND] today"
    assert pii.redact(awkward).columns == awkward.columns
    assert pii.redact(awkward).count() == awkward.count()
    assert pii.find(empty).count() == 0 and pii.redact(empty).count() == 0


def plain_trust(edges, min_seeds, min_confidence):
    """The same scores over the same edges, one pattern and one value after the other."""
    trust = {value: 1.0 for _, value, seed, *_ in edges if seed}
    known = -1
    while len(trust) > known:
        known = len(trust)
        best = dict(trust)
        for pattern in {edge[0] for edge in edges}:
            own = [edge for edge in edges if edge[0] == pattern]
            held = [trust[edge[1]] for edge in own if edge[1] in trust]
            weight = sum((1.0 if e[1] in trust else e[4]) + e[5] for e in own)
            if len(held) >= min_seeds and weight and sum(held) / weight >= min_confidence:
                for _, value, seed, plain, *_ in own:
                    if not seed and not plain:
                        best[value] = max(best.get(value, 0), sum(held) / weight)
        trust = best
    fresh = {value for _, value, seed, plain, *_ in edges if not seed and not plain}
    return {value: round(trust[value], 9) for value in fresh & set(trust)}


@pytest.mark.parametrize("seed", range(4))
def test_trust_spreads_as_in_brute_force(spark, seed):
    random = np.random.default_rng(seed)
    kinds = {f"v{k}": (k < 12, k >= 34) for k in range(40)}  # seeds, then fresh, then plain
    edges = {}
    for _ in range(260):
        pattern, value = int(random.integers(25)), f"v{random.integers(40)}"
        weight, against = float(random.choice([0.1, 0.2])), int(random.integers(20) == 0)
        edges[f"p{pattern}", value] = (f"p{pattern}", value, *kinds[value], weight, against)
    # A chain: each link is trusted only after the one before, more than three rounds long.
    for k in range(6):
        for j in range(5):
            held = (f"c{k}", f"s{j}" if k == 0 else f"l{k - 1}-{j}", k == 0, False, 0.1, 0)
            edges[held[:2]] = held
            edges[f"c{k}", f"l{k}-{j}"] = (f"c{k}", f"l{k}-{j}", False, False, 0.1, 0)
    rows = list(edges.values())
    frame = spark.createDataFrame(
        rows, "pattern string, value string, seed boolean, plain boolean, weight double, against bigint"
    )
    found = {r.value: round(r.trust, 9) for r in pii.trusted_values(frame, 3, 0.5).collect()}
    assert found == plain_trust(rows, 3, 0.5)
    assert {f"l5-{j}" for j in range(5)} <= set(found)


def test_identifiers_of_many_shapes_are_candidates(spark):
    shapes = [
        "EMP-004217", "PAT-2024-0012", "GB-29-NWBK-1234", "EMP004217", "AB12-3456",
        "0x" + "9f3A" * 10, "555.123.4567", "0044 20 7946 0958", "(555) 123-4567",
        "GB29 NWBK 6016 1331 9268 19", "12/345/678", "7" * 60,
    ]
    for shape in shapes:
        text = f"the badge code, {shape}. Then"
        found = [(one["start"], one["end"]) for one in pii.instances(text)]
        assert (16, 16 + len(shape)) in found, shape
    found = pii.instances("in 2024 a well-known e-mail, and/or p. 12 3rd")
    assert pii.FOUND not in [one["kind"] for one in found]
    rows = [(k, f"member number is a{k}b@mail.example.com today") for k in range(200)]
    rows += [(1000 + k, f"member number is {shape} today") for k, shape in enumerate(shapes)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    done = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert {done[1000 + k] for k in range(len(shapes))} == {"member number is [FOUND] today"}


def test_patterns_back_off_and_heed_other_values(spark):
    rows = [(k, f"holder account number is a{k}b@mail.example.com today") for k in range(40)]
    rows += [(100 + k, f"account number is KD-{7000 + k} today") for k in range(15)]
    rows += [(200 + k, f"see page number a{k}c@mail.example.com here") for k in range(20)]
    rows += [(300 + k, f"see page number {k} here") for k in range(15)]
    rows += [(400, "see page number 12/KX345 here"), (401, "your account number is KD-1 today")]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(frame).collect()}
    assert all(found[100 + k] == [pii.FOUND] for k in range(15))
    assert found[400] == [] and found[401] == [] and found[300] == []


def test_identifiers_next_to_others_are_found(spark):
    docs = frames.table(spark, "/root/testdata/sf0.1", "documents")
    texts = {r.doc_id: r.text for r in docs.where("doc_id in (46, 1262, 1377, 7052)").collect()}
    lost = {
        46: "4845168114407329", 1262: "4550997810720808",
        1377: "+1 (826) 555-4081", 7052: "+1 (843) 555-7672",
    }
    found = {r.doc_id: r.spans for r in pii.find(docs).where("size(spans) > 0").collect()}
    for doc, value in lost.items():
        spans = [texts[doc][s.start : s.end] for s in found[doc] if s.kind == pii.FOUND]
        assert value in spans, (doc, spans)
    for doc in (45, 1619):  # as long as a card, but without its check
        assert all(s.kind != pii.FOUND for s in found.get(doc, []))


# -- near-duplicates -----------------------------------------------------------------


def word_sets(rows):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        last = max(1, len(words) - 4)
        sets[doc] = {tuple(words[k : k + 5]) for k in range(last)} if words else set()
    return sets


def brute_components(sets):
    root = {doc: doc for doc in sets}
    order = sorted(sets)
    for a in order:
        for b in order:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root[a], root[b]))
                root = {doc: low if r == high else r for doc, r in root.items()}
    return root


def test_components_equal_brute_force(spark, documents):
    sets = word_sets(documents.items())
    root = brute_components(sets)
    for row in queries.op4_minhash_near_dedup(spark, SF).collect():
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == root[row.doc_id]
        assert row.kept == (row.doc_id == root[row.doc_id])


def test_large_groups_of_near_copies(spark):
    random = np.random.default_rng(5)
    words = [f"w{k}" for k in range(4000)]
    base = list(random.choice(words, 120))
    rows = []
    for k in range(300):  # every copy differs, some too much to be linked
        text = list(base)
        for place in random.choice(120, k % 7, replace=False):
            text[place] = f"x{k}y{place}"
        rows.append((k, " ".join(text)))
    rows += [(1000 + k, " ".join(random.choice(words, 50))) for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    root = brute_components(word_sets(rows))
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()}
    assert found == root


def test_near_duplicates_of_awkward_and_no_rows(awkward, empty):
    found = minhash.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[90].n_shingles == 0 and by_id[90].kept
    assert by_id[None].component_id is None and by_id[None].kept
    assert minhash.near_duplicates(empty).count() == 0


def test_stated_chance_to_miss_a_pair():
    size, share = minhash.COORDINATES, minhash.PERCENT / 100
    missed = sum(
        math.comb(size, k) * share**k * (1 - share) ** (size - k) for k in range(minhash.MATCHES)
    )
    with open(minhash.__file__) as file:
        stated = float(re.search(r"#: of ([0-9.]+) in ten million", file.read())[1])
    assert abs(1e7 * missed - stated) < 0.05


def test_windows_change_no_count_and_no_set(monkeypatch):
    from tripfold.llm import ngrams

    random = np.random.default_rng(2)
    words = ["ab", "É", "the", "longer-word", "x" * 90, "漢字", "the"]
    text = "".join(
        words[random.integers(7)] + " \n\t\xa0"[random.integers(4)] * random.integers(1, 4)
        for _ in range(3000)
    )
    text += "z" * 5000  # longer than any window
    whole = (
        ngrams.word_counts(text, 64).tolist(),
        ngrams.character_counts(text, (1, 2, 3), 64).tolist(),
        shingles.shingle_set(text).tolist(),
    )
    for window in (1, 7, 300, 1 << 30):
        monkeypatch.setattr(ngrams, "WINDOW", window)
        monkeypatch.setattr(shingles, "WINDOW", window)
        assert whole == (
            ngrams.word_counts(text, 64).tolist(),
            ngrams.character_counts(text, (1, 2, 3), 64).tolist(),
            shingles.shingle_set(text).tolist(),
        )


@pytest.mark.parametrize("operator", ["shingles", "words", "characters", "toxicity", "terms"])
def test_a_very_long_text_costs_little_memory(operator):
    """Twenty million characters; what is held beyond the text stays far below ten times it."""
    import tracemalloc

    from tripfold.llm import divergence, ngrams, toxicity

    text = "some words of a very long text " * 640_000
    data = text.encode()
    work = {
        "shingles": lambda: shingles.shingle_set(text),
        "words": lambda: ngrams.word_counts(text, 4096),
        "characters": lambda: ngrams.character_counts(text, (1, 2, 3), 4096),
        "toxicity": lambda: toxicity.features(text, {}),
        "terms": lambda: sum(len(set(some)) for some in divergence.windows(data)),
    }[operator]
    tracemalloc.start()
    try:
        work()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 80 << 20, peak


def test_tokens_tell_coordinates_and_values_apart():
    random = np.random.default_rng(1)
    least = random.integers(0, 1 << 64, (500, minhash.COORDINATES), dtype=np.uint64)
    upper, lower = zip(*map(shingles.halves, least), strict=True)
    tokens = shingles.tokens(
        np.array([np.frombuffer(u, "<u4") for u in upper]),
        np.array([np.frombuffer(w, "<u2") for w in lower]),
    )
    assert len(np.unique(tokens)) == tokens.size and (tokens >= 0).all()
    assert np.array_equal(tokens & ((1 << 48) - 1), (least >> np.uint64(16)).astype(np.int64))
    assert np.array_equal(tokens >> 48, np.tile(np.arange(minhash.COORDINATES), (500, 1)))


def test_short_texts_are_one_shingle():
    assert len(shingles.shingle_set("\xa0")) == 1 and len(shingles.shingle_set(" ")) == 0
    assert shingles.shingle_set("A b\tc").tolist() == shingles.shingle_set("a B\x0bc").tolist()
    assert shingles.shingle_set("b a c").tolist() != shingles.shingle_set("a b c").tolist()
    assert len(shingles.shingle_set("\xa0")) == 1 and len(shingles.shingle_set(" ")) == 0


# -- learned models ------------------------------------------------------------------

LEARNED = "/root/testdata/sf0.01"


def test_language_on_held_out_rows(spark, awkward, empty):
    truth = {r.doc_id: r.lang for r in frames.table(spark, LEARNED, "documents").collect()}
    held = [r for r in queries.op5_language(spark, LEARNED).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    right = [r.lang_pred == truth[r.doc_id] for r in held]
    assert np.mean(right) > 0.98 and all(0 <= r.score <= 1 for r in held)
    model = language.learn(frames.table(spark, LEARNED, "documents"))
    found = {r.doc_id: r for r in language.identify(awkward, model).collect()}
    assert found[90].lang_pred == found[1].lang_pred == "und"
    nothing = language.learn(empty)
    assert {r.lang_pred for r in language.identify(awkward, nothing).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0


def test_quality_on_held_out_rows(spark, awkward, empty):
    labels = frames.table(spark, LEARNED, "labels")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    scored = queries.op6_quality(spark, LEARNED).collect()
    held = [r for r in scored if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.5) for r in scored)
    model = quality.learn(empty, labels)
    assert {r.score for r in quality.score(awkward, model).collect()} == {0.5}
    assert quality.score(empty, model).count() == 0


def test_samples_are_bounded(spark):
    frame = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).alias("y"))
    counts = sampling.bounded(frame, "y", 300).groupBy("y").count().collect()
    assert {r["count"] for r in counts} == {300}


def test_the_language_gate_keeps_learned_languages_alone(spark):
    """Sentences in languages that no document is in, among whole tables of those that are."""
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах.",
        "人人生而自由,在尊严和权利上一律平等。",
        "Minden emberi lény szabadon születik és egyenlő méltósága és joga van.",
        "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm.",
    ]
    docs = frames.table(spark, "/root/testdata/sf0.1", "documents")
    rows = [(10**7 + k, text, None, "web", len(text)) for k, text in enumerate(foreign)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.keep_language(spark, both, "").select("doc_id").collect()}
    assert not kept & {row[0] for row in rows}
    known = {r.doc_id for r in docs.where("length(text) > 0").select("doc_id").collect()}
    assert len(known - kept) <= 0.002 * len(known)


# -- the pipeline --------------------------------------------------------------------


def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    docs = frames.table(spark, SF, "documents")
    columns, before = docs.columns, docs.collect()
    scores = {
        r.doc_id: r.score
        for r in quality.score(
            docs, quality.learn(docs, frames.table(spark, SF, "labels"))
        ).collect()
    }
    kept = None
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, SF)
        rows = after.collect()
        if number < 4:
            assert after.columns == columns
        if name == "quality":
            expected = {r.doc_id for r in before if scores[r.doc_id] >= 0.5}
            assert {r.doc_id for r in rows} == expected
        if name == "near_duplicates":
            root = brute_components(word_sets([(r.doc_id, r.text) for r in kept]))
            assert {r.doc_id for r in rows} == {d for d, r in root.items() if d == r}
        if name == "personal_data":
            assert {r.doc_id for r in rows} == {r.doc_id for r in kept}
            assert not any("@mail" in r.text for r in rows)
        if name == "packing":
            assert {r.doc_id for r in rows} == {r.doc_id for r in kept}
        kept = rows
        path = f"{tmp_path}/{number}"
        after.write.parquet(path)
        docs = spark.read.parquet(path)
    got = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    assert got == {r.doc_id for r in kept}
