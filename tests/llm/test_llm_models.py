"""Toxicity, clustering, source divergence and the samples models learn from, against brute
force on small tables with every awkward case."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripfold.llm import (
    boosting,
    clustering,
    divergence,
    frames,
    language,
    quality,
    queries,
    sampling,
    toxicity,
    transducer,
)

SF = "/root/testdata/sf0.001"


def against_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "embeddings"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = engine.execute(queries.ORACLE[name])
    columns = [d[0] for d in result.description]
    expected = Counter(result.fetchall())
    frame = queries.QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(columns)
    assert Counter(tuple(r) for r in frame.select(*columns).collect()) == expected


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    against_sql(spark, name)


# -- samples -------------------------------------------------------------------------


def test_a_sample_holds_identifiers_once(spark):
    rows = [(k % 2, "ab"[k % 2]) for k in range(20_000)] + [(k, "a") for k in range(2, 12)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, label string")
    once = sampling.bounded(labelled, "label", 100).collect()
    assert sorted(r.doc_id for r in once) == list(range(12))
    some = sampling.bounded(labelled, "label", 4).collect()
    assert Counter(r.label for r in some) == {"a": 4, "b": 1}
    assert sampling.bounded(labelled.limit(0), "label", 4).collect() == []
    nulls = spark.createDataFrame([(None, "a")] * 3, "doc_id bigint, label string")
    assert sampling.bounded(nulls, "label", 4).count() == 1


def not_held_out(number):
    import zlib

    return [k for k in range(10 * number) if zlib.crc32(str(k).encode()) % 3 != 1][:number]


def test_models_learn_from_hot_identifiers(spark):
    one, other, *rest = not_held_out(40)
    hot = [(one, "the cat and the dog", "en")] * 3000 + [(other, "der hund und die katze", "de")] * 3000
    docs = spark.createDataFrame(
        hot + [(k, "the cat" if k % 2 else "der hund", "en" if k % 2 else "de") for k in rest],
        "doc_id bigint, text string, lang string",
    )
    model = language.learn(docs, max_rows=10)
    assert model.predict("the dog and the cat")[0] == "en"
    assert model.predict("die katze und der hund")[0] == "de"
    labels = spark.createDataFrame([(one, 1), (other, 0)], "doc_id bigint, quality int")
    learned = quality.learn(docs, labels, max_rows=10)
    assert learned.score("the cat and the dog") > 0.5 > learned.score("der hund und die katze")


# -- toxicity ------------------------------------------------------------------------


def named(text):
    return dict(zip(toxicity.FEATURES, toxicity.features(text, {}), strict=True))


def test_features_see_manner():
    plain = named("You are a kind reader of long books.")
    assert plain["insult_count"] == 0 and plain["nearest"] == 2 * toxicity.REACH
    rude = named("you IDIOT!! what a st00pid, w o r t h l e s s loooser")
    assert rude["insult_count"] == pytest.approx(math.log(2))
    assert rude["nearest"] == 1 and rude["mark_runs"] > 0 and rude["shouted"] > 0
    assert rude["spaced"] > 0 and rude["drawn_out"] > 0
    assert named("1d10t")["disguised_hits"] > 0 and named("st0p1d")["disguised"] > 0
    assert named("IDIOTA ESTÚPIDO")["insult_count"] > 0
    assert named("")["length"] == 0
    assert named("İ İ a")["capitals"] == pytest.approx(2 / 3)


def test_long_texts_count_across_windows(monkeypatch):
    text = "you are an idiot and a clown " * 400 + "x" * 500 + " fool"
    whole = toxicity.features(text, {"clow": 2.0})
    monkeypatch.setattr(toxicity, "WINDOW", 1 << 30)
    assert np.allclose(toxicity.features(text, {"clow": 2.0}), whole)
    monkeypatch.setattr(toxicity, "WINDOW", 700)
    assert np.allclose(toxicity.features(text, {"clow": 2.0}), whole)
    assert "".join(toxicity.windows("ab" * 5000)) == "ab" * 5000


def test_a_lexicon_is_learned_from_counts():
    rows = np.array([[40, 40, 40], [20, 20, 20]])
    counts = {
        "brüll": [[0, 1, 0], [9, 9, 9]],
        "brül": [[0, 1, 0], [9, 9, 9]],
        "brülle": [[0, 0, 0], [3, 3, 3]],
        "house": [[20, 20, 20], [10, 10, 10]],
        "once": [[0, 0, 0], [9, 0, 0]],
        "rare": [[0, 0, 0], [1, 1, 1]],
    }
    found = [(beginning, np.array(n)) for beginning, n in counts.items()]
    assert set(toxicity.lexicon_of(found, rows)) == {"brüll", "once"}
    assert set(toxicity.lexicon_of(found, rows, 0)) == {"brüll"}
    assert toxicity.lexicon_of(found, rows * [[1], [0]]) == {}
    assert toxicity.beginnings("Brülle an BRÜLL!") == {"brül", "brüll", "brülle"}
    assert named("")["learned_rate"] == 0
    plain, own = (toxicity.features("so a clown", x)[8] for x in ({}, {"clow": 2.0}))
    assert (plain, own) == (0, pytest.approx(1 / 3))


def test_trees_and_isotonic_against_plain_versions():
    random_ = np.random.default_rng(4)
    rows = random_.normal(size=(600, 3))
    labels = ((rows[:, 0] > 0.3) & (rows[:, 1] < 0.5)).astype(np.int64)
    model = boosting.Calibrated(rows, labels, np.ones(600), np.arange(600) % 3)
    assert ((model.scores(rows) >= 0.5) == labels).mean() > 0.97
    trees = model.trees

    def plain(row):
        total = trees.base
        for features, limits, leaves in zip(trees.features, trees.limits, trees.leaves, strict=True):
            node = 0
            for _ in range(boosting.DEPTH):
                node = 2 * node + 1 + int(row[features[node]] > limits[node])
            total += leaves[node - len(features)]
        return total

    assert np.allclose(trees.margins(rows[:50]), [plain(row) for row in rows[:50]])
    margins, marks = random_.normal(size=40).round(1), random_.integers(0, 2, 40)
    weights = random_.integers(1, 4, 40).astype(float)
    fitted = boosting.Isotonic(margins, marks, weights)
    for at in set(margins.tolist()):  # max over starts of min over ends of means
        starts = [m for m in set(margins.tolist()) if m <= at]
        ends = [m for m in set(margins.tolist()) if m >= at]
        best = max(
            min(
                np.average(marks[(margins >= a) & (margins <= b)],
                           weights=weights[(margins >= a) & (margins <= b)])
                for b in ends
            )
            for a in starts
        )
        assert fitted(np.array([at]))[0] == pytest.approx(best)
    alone = boosting.Calibrated(rows, np.ones(600, dtype=np.int64), np.ones(600), np.zeros(600))
    assert alone.scores(rows[:2]).tolist() == [0.5, 0.5]


def test_toxicity_on_held_out_rows(spark):
    found = {r.doc_id: r for r in queries.op11_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = frames.table(spark, "/root/testdata/sf0.1", "labels").collect()
    rows = [(r.toxic, found[r.doc_id]) for r in labels if found[r.doc_id].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for _, r in rows)
    caught = [r.predicted for toxic, r in rows if toxic]
    spared = [1 - r.predicted for toxic, r in rows if not toxic]
    assert len(caught) > 100 and np.mean(caught) > 0.9
    assert np.mean(spared) > 0.995


def test_toxicity_of_awkward_tables(spark):
    ids = not_held_out(60)
    texts = ["you are a worthless idiot" if k % 2 else "a calm and quiet day" for k in range(60)]
    rows = [(i, t, 1, 0.5, "f") for i, t in zip(ids, texts, strict=True)] * 2
    rows += [(None, None, None, None, None), (10**6, "", 1, 1.0, ""), (10**6, None, 1, 1.0, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label int, score double, fold string")
    labels = spark.createDataFrame(
        [(i, k % 2) for k, i in enumerate(ids)] + [(ids[0], 1), (None, 1), (ids[2], 7)],
        "doc_id bigint, toxic int",
    )
    model = toxicity.learn(docs, labels)
    found = toxicity.score(docs, model)
    assert found.columns == ["doc_id", "score"] and found.count() == len(rows)
    scores = {r.doc_id: r.score for r in found.collect()}
    assert scores[ids[1]] > 0.7 > 0.3 > scores[ids[4]] and scores[None] == scores[10**6]
    assert toxicity.score(docs.limit(0), model).collect() == []
    untaught = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, untaught).collect()} == {0.5}


# -- clustering ----------------------------------------------------------------------


def plain_lloyd(rows, clusters, rounds, size):
    kept = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    place = lambda row: (
        row[0] is None,
        hashlib.sha256(f"3:{row[0]}".encode()).hexdigest() if row[0] is not None else "",
        row[1],
    )
    centres = [list(v) for _, v in sorted(kept, key=place)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        for k, members in own.items():
            centres[k] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = Counter()
    for _, k, d in found:
        sums[k] += d
    return Counter((i, k, d, sums[k], sum(sums.values()), tuple(centres[k])) for i, k, d in found)


@pytest.mark.parametrize(("columns", "block_rows", "clusters"), [(2, 7, 4), (5, 64, 3), (3, 1, 60)])
def test_clusters_equal_plain_lloyd(spark, columns, block_rows, clusters):
    random_ = np.random.default_rng(columns)
    rows = [(k, random_.normal(0, 3, 5).tolist()) for k in range(50)]
    rows += [rows[3], rows[3], (4, rows[9][1]), (None, [0.5] * 5), (90, [0.0] * 5), (91, [1e-9] * 5)]
    rows += [(92, None), (93, [1.0]), (94, [1.0, None, 1.0, 1.0, 1.0]), (95, [float("nan")] * 5)]
    rows += [(96, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (97, []), (98, [-1.5, 2.25, -0.001, 9.0, 1.0])]
    frame = spark.createDataFrame(
        [(*row, "x", 1) for row in rows], "vec_id bigint, embedding array<double>, cluster string, block int"
    )
    found = clustering.cluster(
        frame.repartition(3), clusters, 5, 5, shard_columns=columns, block_rows=block_rows
    )
    got = Counter((*tuple(r)[:5], tuple(r.centroid)) for r in found.collect())
    assert got == plain_lloyd(rows, clusters, 5, 5)


def test_clusters_of_nothing_and_of_giants(spark):
    schema = "vec_id bigint, embedding array<float>"
    nothing = spark.createDataFrame([(1, None), (2, [1.0])], schema)
    assert clustering.cluster(nothing).collect() == []
    giant = spark.createDataFrame([(1, [3e38] * 64)], schema)
    with pytest.raises(Exception, match="too large"):
        clustering.cluster(giant).collect()


def test_sums_beyond_64_bits_are_exact():
    near = clustering.Moved(np.array([[2**62]], dtype=object), np.array([3]))
    total = near + near + near
    assert total.slice(np.array([[0]])).tolist() == [[3 * 2**62 // 9]]
    below = clustering.Moved(np.array([[-7], [0]], dtype=object), np.array([2, 0]))
    assert below.slice(np.array([[0], [5]])).tolist() == [[-4], [5]]


# -- divergence ----------------------------------------------------------------------


def least_states(terms):
    """Distinct sets of continuations of all prefixes: the states of the least automaton."""
    rest = defaultdict(set)
    for term in terms:
        for k in range(len(term) + 1):
            rest[term[:k]].add(term[k:])
    return len({frozenset(r) for r in rest.values()})


@pytest.mark.parametrize("seed", range(6))
def test_transducers_are_minimal_and_ordered(seed):
    random_ = random.Random(seed)
    alphabet = ["a", "b", "é", "漢"][: 2 + seed % 3]
    words = {"".join(random_.choices(alphabet, k=random_.randint(1, 7))) for _ in range(60)}
    terms = sorted(word.encode() for word in words)
    built = transducer.build(terms)
    assert len(built.final) == least_states(terms)
    assert built.ordinals(terms).tolist() == list(range(len(terms)))
    assert list(built.terms()) == terms
    others = [b"", b"zzz", terms[0] + b"a" * 9, *(t[:-1] for t in terms)]
    places = {term: k for k, term in enumerate(terms)}
    assert built.ordinals(others).tolist() == [places.get(t, -1) for t in others]
    assert transducer.build([]).ordinals([b"", b"a"]).tolist() == [-1, -1]
    with pytest.raises(ValueError, match="order"):
        transducer.build([b"b", b"a"])


def test_windows_cut_no_term(monkeypatch):
    monkeypatch.setattr(divergence, "WINDOW", 5)
    text = "Ab1cdÉ fghijklmnop- q漢 " * 9 + "\x00last"
    terms = [t for some in divergence.windows(text.encode()) for t in some]
    plain = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert [t.decode() for t in terms] == [t.translate(lower) for t in plain]


def plain_audit(rows, min_docs, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups[lang or "", source or ""].update(words)
        held[lang or ""].update(set(words))
    found = []
    for lang, docs in held.items():
        kept = sorted((t for t, n in docs.items() if n >= min_docs), key=str.encode)
        own = {s: c for (g, s), c in groups.items() if g == lang}

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        of_group = {s: shares(c) for s, c in own.items()}
        of_lang = shares(sum(own.values(), Counter()))
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s, p in of_group.items():
            pair = [(-sum(gap(p[t], q[t]) for t in kept), o.encode(), o) for o, q in of_group.items() if o != s]
            found += [(lang, s, "pair", o, -f, k) for k, (f, _, o) in enumerate(sorted(pair), 1)]
            more = [(-gap(p[t], of_lang[t]), t.encode(), t) for t in kept if own[s][t] and p[t] > of_lang[t]]
            found += [(lang, s, "term", t, -f, k) for k, (f, _, t) in enumerate(sorted(more)[:top], 1)]
    return Counter(found)


@pytest.mark.parametrize(
    ("piece_terms", "held_bytes", "chunk", "block"),
    [(250_000, 64 << 20, 4096, 128), (3, 1, 2, 2), (5, 2000, 3, 1)],
)
def test_divergence_equals_brute_force(spark, piece_terms, held_bytes, chunk, block):
    random_ = random.Random(piece_terms)
    words = ["Apple", "apple", "é", "É", "漢", "to-go", "x1y", "zebra", "Zeal", "tie", "a", "\x00b"]
    rows = [
        (" ".join(random_.choices(words, k=random_.randint(0, 9))), random_.choice(["en", "de", "fr"]),
         random_.choice(["s1", "s2", "s10", "É"]))
        for _ in range(60)
    ]
    rows += [rows[0]] * 5 + [(None, None, None), ("apple tie", None, "s1"), ("", "en", "silent")]
    rows += [("only one", "xx", "s1"), ("another", "xx", "s2"), ("lonely", "yy", "s1")]
    docs = spark.createDataFrame(
        [(*row, 7, 1, "x") for row in rows], "text string, lang string, source string, n int, place int, term string"
    )
    found = divergence.audit(
        docs.repartition(4), 3, 2, piece_terms=piece_terms, held_bytes=held_bytes, chunk=chunk, block=block
    )
    assert Counter(map(tuple, found.collect())) == plain_audit(rows, 3, 2)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_divergence_of_a_very_long_text(spark):
    long = "apple tie " * 200_000 + "q" * 3_000_000
    rows = [(long, "en", "s1"), ("apple", "en", "s2"), (long[:100], "en", "s2")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert Counter(map(tuple, divergence.audit(docs, 2, 3).collect())) == plain_audit(rows, 2, 3)


def test_a_hot_label_column_clashes_with_nothing(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s")], "doc_id int, text string, LANG string, source string")
    renamed = docs.withColumnRenamed("LANG", "language")
    assert divergence.audit(renamed, 1, lang_col="language").where(F.col("part") == "term").count() == 0
