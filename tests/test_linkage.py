"""Retrieval, unions, features, metrics, checks and files on small records."""

import difflib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from knotwork.operators import features, index, matching, metrics, retrieve, union, validate
from knotwork.operators.records import enrich
from knotwork.plans import entities, queries
from knotwork.plans.linkage import link, training_pairs, write_results
from knotwork.sources import files
from knotwork.streaming.linkage import link_stream

SCHEMA = "entity_id string, business_name string, business_address string, country string, ord long"
# A small index and queries with known answers.
TARGETS = [
    ("S2-101", "Starbucks Coffee Company", "2401 Utah Ave S, Seattle WA 98134", "US"),
    ("S2-102", "Müller Drogerie Markt", "Albstraße 92, 89081 Ulm", "DE"),
    ("S2-103", "Microsoft Corporation", "One Microsoft Way, Redmond, WA 98052", "US"),
    ("S2-104", "Acme Industrial Supplies", "123 Industrial Rd, Chicago, IL 60601", "US"),
    ("S3-201", "Starbucks Seattle Store", "2401 Utah Avenue South 98134", "US"),
    ("S3-202", "Mueller Drogeriemarkt GmbH", "Albstrasse 92, Ulm 89081", "DE"),
    ("S3-203", "Microsft Corp", "1 Microsoft Way 98052", "US"),
]
QUERIES = [
    ("S1-001", "Starbucks Coffee Company", "", "US"),
    ("S1-002", "Microsoft Corporation", "One Microsoft Way, Redmond 98052", "US"),
    ("S1-003", "Coffee Shop #442", "2401 Utah Ave, Seattle, WA 98134", "US"),
    ("S1-004", "Müller Drogerie", "", "DE"),
    ("S1-005", "Müller Drogerie Markt", None, "FR"),
    ("S1-006", None, None, None),
]


def records(spark, rows):
    return enrich(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA))


@pytest.fixture(scope="module")
def small(spark):
    return records(spark, QUERIES).cache(), records(spark, TARGETS).cache()


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.q, set()).add(r.id)
    return out


def test_known_answers(small):
    q, t = small
    exact = found(retrieve.exact(q, t))
    assert exact["S1-001"] == {"S2-101"} and "S3-203" not in exact["S1-002"]
    assert exact["S1-005"] == {"S2-102"}, "no such name in its country: anywhere"
    assert "S3-203" in found(retrieve.by_terms(q, t, "char3", 10))["S1-002"]
    assert found(retrieve.by_address(q, t, 10))["S1-003"] & {"S2-101", "S3-201"}
    full = {r.q: r.candidates for r in union.candidates(q, t, "ablation_E_full_hybrid", 10).collect()}
    assert "S2-102" in full["S1-004"] and full["S1-006"] == [] and len(full) == len(QUERIES)


def made(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("al", "be", "ga", "de", "ep") for b in ("pha", "ta", "mma", "lta")]
    rows = []
    for i in range(n):
        name = " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
        addr = "" if rng.random() < 0.15 else " ".join([str(rng.randint(100, 130)), *[rng.choice(words) for _ in range(2)]])
        rows.append((f"S{i % 3 + 1}-{i}", name, addr, rng.choice(["US", "FR", "us ", None])))
    return rows


def brute_search(queries, targets, kind, k, cap):
    """The retrieval rules, record by record."""
    terms = {"tokens": lambda r: [x for x in r.name_tokens if len(x) > 1], "char3": lambda r: r.char3, "char4": lambda r: r.char4}[kind]
    fall, rest = (0.1, 2) if kind == "tokens" else (0.05, 4)
    out = {}
    for src in ("S2", "S3"):
        own = [t for t in targets if t.src == src]
        df = {}
        for t in own:
            for x in terms(t):
                df[x] = df.get(x, 0) + 1
        known = {t.country for t in own if terms(t)}
        for q in queries:
            scope = [t for t in own if q.country not in known or t.country == q.country]
            there = {x for t in scope for x in terms(t)}
            asked = [x for x in (q.name_tokens if kind == "tokens" else terms(q)) if x in there]
            fits = [x for x in asked if df[x] <= cap] or sorted(asked, key=lambda x: (df[x], x))[:rest]
            score = {}
            for t in scope:
                w = sum(1 / (1 + fall * max(1, df[x])) for x in fits if x in set(terms(t)))
                if w:
                    score[t.id] = (-round(w, 12), t.ord)
            out[q.id, src] = sorted(score, key=score.get)[:k]
    return out


@pytest.fixture(scope="module")
def random_sides(spark):
    every = records(spark, made(3, 150)).cache()
    return every.where("src = 'S1'").cache(), every.where("src <> 'S1'").cache()


@pytest.mark.parametrize("kind", ["tokens", "char3", "char4"])
@pytest.mark.parametrize("cap", [3, 12, 5000])
def test_search_against_brute_force(random_sides, kind, cap):
    q, t = random_sides
    want = brute_search(q.collect(), t.collect(), kind, 7, cap)
    got = {}
    for r in sorted(retrieve.by_terms(q, t, kind, 7, cap).collect(), key=lambda r: r["rank"]):
        got.setdefault((r.q, r.src), []).append(r.id)
    assert got == {key: ids for key, ids in want.items() if ids}


def test_equal_weights_are_ties_whatever_their_order(spark):
    """Two records meet the same weights by different words: their sums are the same to the last bit, and the first one goes first.

    The sums are a hair from where twelve digits are rounded up or down. Joins are those of large tables, in which words meet in any order.
    """
    drawn = np.random.default_rng(5).integers(1, 10, (100_000, 24))
    exact_sums = (1 / (1 + 0.1 * drawn)).astype(np.longdouble).sum(axis=1) * 1e12
    rows, close = [], drawn[np.abs(exact_sums % 1 - 0.5) < 1e-3][:100].tolist()
    for g, df in enumerate(close):
        name = lambda side, least, g=g, df=df: " ".join(f"{side}{g}x{i}" for i, n in enumerate(df) if n >= least)
        rows += [(f"S1-{g}", f"{name('t', 1)} {name('u', 1)}", "", "US"), (f"S2-{g}a", name("t", 1), "", "US"), (f"S2-{g}b", name("u", 1), "", "US")]
        rows += [(f"S2-{g}c{n}", f"{name('t', n)} {name('u', n)}", "", "US") for n in range(2, 10)]
    every = records(spark, rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        ranked = {(r.q, r.id): r for r in retrieve.by_terms(every.where("src = 'S1'"), every.where("src = 'S2'"), "tokens", 12).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(close) == 100
    for g in range(len(close)):
        a, b = (ranked[f"S1-{g}", f"S2-{g}{x}"] for x in "ab")
        assert a.score == b.score and a.rank + 1 == b.rank


def fold(tiers, strategy, k):
    """The union rules, step by step."""
    out = list(dict.fromkeys(tiers["exact_S2"] + tiers["exact_S3"])) if strategy.exact else []
    for tier, share in strategy.tiers:
        if len(out) >= k:
            break
        quota = max(1, int((k - len(out)) * share))
        half = max(1, quota // 2) if strategy.halved else quota
        for x in tiers[f"{tier}_S2"][:half] + tiers[f"{tier}_S3"][:half]:
            if x not in out and len(out) < k:
                out.append(x)
    return out[:k]


@pytest.mark.parametrize("name", list(union.STRATEGIES))
def test_unions_against_brute_force(random_sides, name):
    q, t = random_sides
    s = union.STRATEGIES[name]
    names = tuple(dict.fromkeys(["exact", *[x for x, _ in s.tiers]]))
    tiered = union.tiers(q, t, names, 9, 12).cache()
    for k in (3, 9):
        got = {r.q: r.candidates for r in union.merge(tiered, s, k).collect()}
        want = {r.q: fold(r.asDict(), s, k) for r in tiered.collect()}
        assert got == want


def test_union_over_one_source(random_sides):
    q, t = random_sides
    got = {r.q: r.candidates for r in union.single_source(q, t, "S3", 8, 12).collect()}
    assert all(x.startswith("S3-") for c in got.values() for x in c) and max(map(len, got.values())) <= 8


def test_merging_tiers_early_or_late_is_the_same(random_sides):
    """Lists of the best h are beginnings of lists of the best k, so tiers made once serve every strategy."""
    q, t = random_sides
    tiered = union.tiers(q, t, k=50, cap=12)
    for name in ("ablation_E_full_hybrid", "ablation_B_char3"):
        late = {r.q: r.candidates for r in union.merge(tiered, union.STRATEGIES[name], 10).collect()}
        early = {r.q: r.candidates for r in union.candidates(q, t, name, 10, 12).collect()}
        assert late == early


def varied(rng, text):
    """The text with a word dropped, doubled, misspelt or moved."""
    words = text.split()
    if not words:
        return text
    at = rng.randrange(len(words))
    how = rng.randrange(4)
    if how == 0 and len(words) > 1:
        del words[at]
    elif how == 1:
        words.insert(at, words[at])
    elif how == 2:
        words[at] = words[at][::-1]
    else:
        words.append(words.pop(at))
    return " ".join(words)


def test_features(spark):
    rng = random.Random(9)
    parts = ["kelp", "reef", "рыба", "漁港", "öre", "tide", "quay", "naïf", "a", "zz"]
    pairs = []
    for i in range(40):
        name = " ".join(rng.choice(parts) for _ in range(rng.randint(1, 5)))
        address = "" if rng.random() < 0.25 else " ".join([str(rng.randint(100, 99999)), *[rng.choice(parts) for _ in range(3)]])
        other = "" if rng.random() < 0.25 else address if rng.random() < 0.4 else varied(rng, address)
        pairs.append(((f"S1-{i}", name, address, rng.choice(["", "NO"])), (f"S{2 + i % 2}-{i}", name if i % 4 == 0 else varied(rng, name), other, "NO")))
    q, t = records(spark, [a for a, _ in pairs]), records(spark, [b for _, b in pairs])
    asked = spark.createDataFrame([(a[0], b[0]) for a, b in pairs], "q string, id string")
    got = {r.q: r for r in features.featurize(asked, q, t).collect()}
    x, y = {r.id: r for r in q.collect()}, {r.id: r for r in t.collect()}
    assert len(features.FEATURES) == 25
    jac = lambda a, b: len(a & b) / len(a | b) if a and b else 0.0
    for a, b in pairs:
        r, u, v = got[a[0]], x[a[0]], y[b[0]]
        assert r.name_seq_sim == pytest.approx(difflib.SequenceMatcher(None, u.norm_name, v.norm_name).quick_ratio())
        assert r.addr_seq_sim == pytest.approx(difflib.SequenceMatcher(None, u.norm_addr, v.norm_addr).quick_ratio() if u.norm_addr and v.norm_addr else 0)
        for name, column in (("name_token_jaccard", "name_tokens"), ("name_char3_jaccard", "char3"), ("name_char4_jaccard", "char4"), ("addr_token_jaccard", "addr_tokens"), ("addr_char3_jaccard", "addr_char3"), ("combined_token_jaccard", "comb")):
            assert r[name] == pytest.approx(jac(set(u[column]), set(v[column])))
        assert r.postal_overlap_count == len(set(u.postal) & set(v.postal)) and r.is_source2 == b[0].startswith("S2")
        assert r.country_match == 1.0 and r.name_exact_match == (u.norm_name == v.norm_name)
        assert (r.s1_addr_missing, r.cand_addr_missing, r.both_addr_missing) == (u.norm_addr == "", v.norm_addr == "", u.norm_addr == v.norm_addr == "")
    assert any(r.addr_exact_match for r in got.values()) and any(r.both_addr_missing for r in got.values())
    assert features.featurize(asked, q, t, zero_addr_char3=True).agg(F.max("addr_char3_jaccard")).first()[0] == 0.0


def test_metrics(spark):
    q = spark.createDataFrame([(x,) for x in "abcde"], "q string")
    true = spark.createDataFrame([("c", "x"), ("d", "S2-47"), ("d", "S3-12"), ("e", "y")], "q string, id string")
    pred = spark.createDataFrame([("b", "x"), ("d", "S2-47"), ("d", "S2-93"), ("d", "S3-12"), ("e", "z")], "q string, id string")
    got = {r.q: (r.precision, r.recall, round(r.f05, 6)) for r in metrics.by_entity(q, true, pred).collect()}
    assert got == {"a": (1, 1, 1), "b": (0, 1, 0), "c": (1, 0, 0), "d": (2 / 3, 1, 0.714286), "e": (0, 0, 0)}
    s = metrics.summary(metrics.by_entity(q, true, pred)).first()
    assert (s.true_pairs, s.predicted_pairs, s.true_positives, s.singletons, s.correct_singletons) == (4, 5, 2, 2, 1)
    scored = pred.withColumn("p", F.when(F.col("id").isin("S2-47", "S3-12"), 0.7).otherwise(0.4))
    sweep = {r.tau: r.macro_f05 for r in metrics.threshold_sweep(q, true, scored).collect()}
    for tau in (0.15, 0.41, 0.71, 0.89):
        own = metrics.by_entity(q, true, scored.where(F.col("p") >= tau)).agg(F.avg("f05")).first()[0]
        assert sweep[tau] == pytest.approx(own)
    assert metrics.best_threshold(metrics.threshold_sweep(q, true, scored)).first().tau == 0.41
    assert metrics.gain(true, pred, pred.where("q <> 'd'")).first().new_pairs == 2


def test_checks(spark):
    lines = ["S1-1\tS2-1,S3-1", "S1-2\tS2-1,S2-1", "S1-3\tS1-1", "S1-4\tX-9", "S1-5\tS2-77", "S1-6 no tab", "S1-1\t", "S1-99\t", ""]
    rows = validate.parse(spark.createDataFrame([(x,) for x in lines], "value string"))
    q = spark.createDataFrame([(f"S1-{i}",) for i in range(1, 8)], "q string")
    t = spark.createDataFrame([("S2-1",), ("S3-1",)], "id string")
    candidates = validate.parse(spark.createDataFrame([("S1-1\tS2-1",)], "value string"))
    got = {r.code: (r.severity, r["count"]) for r in validate.report(rows, candidates, q, t).collect()}
    assert got["no_tab"] == ("error", 1) and got["duplicate_row"][1] == 1 and got["duplicate_id"][1] == 1 and got["self_match"][1] == 1
    assert got["bad_prefix"][1] == 1 and got["unknown_id"][1] == 1 and got["missing_s1"][1] == 2 and got["extra_s1"][1] == 2 and got["not_subset"][0] == "warning"
    assert validate.header_problem("source1_entity_id\tmatched_entity_ids", "matching") is None
    assert validate.header_problem("source1_entity_id,matched_entity_ids", "matching") == "columns separated by commas"
    assert validate.header_problem("", "matching") == "empty file" and validate.header_problem("a\tb", "candidate") == "wrong header"
    parts = [validate.partition_bounds(10, w, 3) for w in range(3)]
    assert parts == [(0, 4), (4, 7), (7, 10)]
    halves = [rows.where("q = 'S1-1'").limit(1), rows.where("q IN ('S1-2', 'S1-3')")]
    assert validate.merge_parts(halves, q.where("q <= 'S1-3'")).count() == 3
    with pytest.raises(ValueError, match="missing_s1"):
        validate.merge_parts(halves, q)


def test_files(spark, tmp_path, monkeypatch, small):
    q, t = small
    folder = tmp_path / "data" / "test"
    folder.mkdir(parents=True)
    text = 'entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\t"Q ""x"" co"\t\tUS\nS2-2\tplain "mid" field\tRoad 1\n\tno id\t\t\n'
    (folder / "TEST_source2.TSV").write_text(text)
    place = files.data_file(tmp_path / "data", "test", "source2")
    assert place.name == "TEST_source2.TSV" and files.data_file(tmp_path, "train", "none").name == "train_none.tsv"
    got = [tuple(r) for r in files.read_records(spark, str(place), ordered=True).orderBy("ord").collect()]
    assert got == [("S2-1", 'Q "x" co', "", "US", 0), ("S2-2", 'plain "mid" field', "Road 1", "", 1)]
    assert files.count_lines(spark, str(place)) == 4 and {r.id for r in files.read_ids(spark, str(place)).collect()} == {"S2-1", "S2-2"}
    (tmp_path / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-2\nS1-2\t\n")
    true = files.read_truth(spark, str(tmp_path / "truth.tsv"))
    assert {r.q: r.ids for r in true.collect()} == {"S1-1": ["S2-1", "S3-2"], "S1-2": []} and files.truth_pairs(true).count() == 2
    monkeypatch.setenv(files.DATA_VARIABLE, str(tmp_path))
    assert files.data_dir() == tmp_path and files.data_dir(str(folder)) == folder
    write_results(link(q, t, k=5, threshold=0.5), q, str(tmp_path / "out"))
    header, lines = files.read_result_lines(spark, str(tmp_path / "out" / "matching_results.tsv"))
    rows = validate.parse(lines)
    assert header == "source1_entity_id\tmatched_entity_ids" and '"' not in "".join(r.value for r in lines.collect())
    _, c = files.read_result_lines(spark, str(tmp_path / "out" / "candidate_pairs.tsv"))
    checks = validate.report(rows, validate.parse(c), q.select(F.col("id").alias("q")), t)
    assert checks.where("count > 0").count() == 0
    stage = files.write_stage(q.select("id"), str(tmp_path / "stage"))
    before = os.path.getmtime(tmp_path / "stage" / "_SUCCESS")
    assert files.write_stage(q.select("id"), str(tmp_path / "stage")).count() == stage.count() and os.path.getmtime(tmp_path / "stage" / "_SUCCESS") == before


def test_models(spark, random_sides, tmp_path):
    q, t = random_sides
    truth = q.select(F.col("id").alias("q"), "norm_name").join(t.select("id", "norm_name"), "norm_name").select("q", "id")
    pairs = training_pairs(q, t, truth, "ablation_A_disjunctive", 10).cache()
    for kind, params in (("gbt", {"maxIter": 5, "minInstancesPerNode": 2}), ("logistic", {})):
        model = matching.fit(pairs.where("train"), kind, **params)
        scored = matching.probability(model, pairs)
        means = {r.label: r.p for r in scored.groupBy("label").agg(F.avg("p").alias("p")).collect()}
        assert means[1] > means[0] + 0.2 and set(matching.importances(model)) == set(features.FEATURES)
        matching.save(model, str(tmp_path / kind), features.FEATURES, 0.5)
        again, about = matching.load(spark, str(tmp_path / kind))
        assert about["best_threshold"] == 0.5 and matching.probability(again, pairs).count() == pairs.count()
    assert matching.best_owner(scored).groupBy("id").count().where("count > 1").count() == 0


def test_stream(spark, small, tmp_path):
    _, t = small
    source = spark.createDataFrame([r for r in QUERIES if r[1]], "entity_id string, business_name string, business_address string, country string")
    source.write.parquet(str(tmp_path / "in"))
    arrivals = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    link_stream(arrivals, t, str(tmp_path / "out"), str(tmp_path / "state"), k=5, threshold=0.5).awaitTermination()
    got = found(spark.read.parquet(str(tmp_path / "out")))
    assert got["S1-001"] >= {"S2-101"}


def test_plans_have_no_nested_loops(random_sides):
    q, t = random_sides
    for frame in (retrieve.by_terms(q, t, "char3", 10, 12), retrieve.by_address(q, t, 10, 12), retrieve.exact(q, t, 10), union.candidates(q, t, "ablation_E_full_hybrid", 10, 12)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    ranked = retrieve.by_terms(q, t, "tokens", 10, 12)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in ranked


@pytest.mark.parametrize("k", [1, 3, None])
def test_exact_names_against_brute_force(random_sides, k):
    q, t = random_sides
    got, targets = {}, t.collect()
    for r in sorted(retrieve.exact(q, t, k).collect(), key=lambda r: r["rank"]):
        got.setdefault((r.q, r.src), []).append(r.id)
    want = {}
    for a in q.collect():
        for src in ("S2", "S3"):
            same = sorted((x for x in targets if x.src == src and x.norm_name == a.norm_name != ""), key=lambda x: (x.ord, x.id))
            here = [x for x in same if x.country == a.country != ""]
            if same:
                want[a.id, src] = [x.id for x in (here or same)][:k]
    assert got == want and any(len(x) > 1 for x in want.values()) == (k != 1)


def test_posting_stats(spark, random_sides):
    _, t = random_sides
    posted = index.postings(t, "tokens")
    rows = [r for r in index.posting_stats(posted).collect() if r.scope == "*"]
    assert sum(r.postings for r in rows) == posted.count()


def test_pairs_travel_without_token_sets(random_sides):
    """A pair is a row of every exchange between its candidate and its query: no array but the short one of postal codes goes with it."""
    q, t = random_sides
    frame = features.featurize(retrieve.exact(q, t, 5).select("q", "id"), q.hint("merge"), t.hint("merge"))
    plan = frame._jdf.queryExecution().optimizedPlan()
    last = plan
    while "Join" not in last.nodeName():
        last = last.children().apply(0)
    carried = last.children().apply(0).output().mkString(",")
    assert "y_norm_name" in carried and not any(f"y_{c}#" in carried for c in ("name_tokens", "addr_tokens", "char3", "char4", "addr_char3", "comb"))


@pytest.mark.parametrize("block", [40, 1_000_000])
def test_search_in_waves(random_sides, monkeypatch, block):
    """The same rows however many blocks, slices and waves there are; a wave sends no more copies than the tables' terms, and no shuffle of it is left."""
    q, t = random_sides
    rows = lambda: sorted(map(tuple, retrieve.by_terms(q, t, "char3", 7, 12).collect()))
    want, sent, kept = rows(), [], retrieve.staged
    monkeypatch.setattr(retrieve, "BLOCK", block)
    monkeypatch.setattr(retrieve, "SLICE", 50)
    monkeypatch.setattr(retrieve, "WAVE", 100)
    monkeypatch.setattr(retrieve, "staged", lambda frame, name: sent.append(name) or kept(frame, name))
    assert rows() == want
    assert sent[0] == "asked" and sent.count("searched") > 1, "query terms are looked up once, not once a wave"


def test_a_posting_travels_as_one_number(random_sides):
    q, t = random_sides
    plan = retrieve.by_terms(q, t, "char3", 7, 12)._jdf.queryExecution().optimizedPlan()
    while "CoGroup" not in plan.nodeName():
        plan = plan.children().apply(0)
    assert plan.children().apply(1).schema().catalogString().count("array<bigint>") == 1


def test_tiers_travel_as_lists(random_sides):
    """A tier's candidates meet the others' as one row a query, and tell sources by column, not by a name in each row."""
    q, t = random_sides
    tiered = union.tiers(q, t, ("tokens", "char3"), 7, 12)
    plan = tiered._jdf.queryExecution().optimizedPlan().toString()
    assert "tier" not in plan and "Union" not in plan
    want = {(r.q, r.src): r.ids for r in retrieve.by_terms(q, t, "char3", 7, 12).groupBy("q", "src").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"]).alias("ids")).collect()}
    assert {(r.q, s): r[f"char3_{s}"] for r in tiered.collect() for s in ("S2", "S3") if r[f"char3_{s}"]} == want


def test_one_block_is_not_ranked_again(random_sides):
    q, t = random_sides
    assert "Window" not in retrieve.by_terms(q, t, "tokens", 7, 12)._jdf.queryExecution().optimizedPlan().toString()


def test_blocking_makes_no_product_of_equal_records(spark):
    """Recall over records of the same texts is that over all their pairs."""
    copies = [(f"S{1 + i % 3}-{i}", "The Same Name" if i % 7 else f"Other {i // 21}", f"{i // 60} Long Road" if i % 5 else None, "US", i) for i in range(360)]
    every = enrich(spark.createDataFrame([*copies, ("S1-900", None, None, None, 900), ("S2-901", None, None, None, 901), ("S1-902", "Alone", "", "", 902)], SCHEMA))
    q, t = every.where("src = 'S1'"), every.where("src <> 'S1'")
    found = retrieve.by_terms(q, t, "tokens", 5, 100).cache()
    want = metrics.blocking(q.select(F.col("id").alias("q")), entities.truth(q, t), found, t).collect()
    assert metrics.blocking_of_equal(q, t, found).collect() == want
    assert 0 < want[0].recovered < want[0].true_pairs and want[0].fully_covered < want[0].covered
    assert metrics.blocking_of_equal(q, t.where("false"), found).collect() == metrics.blocking(q.select(F.col("id").alias("q")), entities.truth(q, t.where("false")), found, t).collect()


def test_blocking_recall_of_many_copies(spark, tmp_path, monkeypatch):
    """3,000 copies of one text are two million true pairs, and they are counted, not made."""
    spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one two three four five six").alias("text"), F.lit("en").alias("lang"), F.lit(27).cast("long").alias("n_chars")).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(entities, "truth", lambda *_: pytest.fail("pairs are made"))
    row = queries.blocking_recall(spark, str(tmp_path)).collect()[0]
    assert (row.true_pairs, row.recovered, row.recall, row.entities, row.covered, row.fully_covered) == (2_000_000, 100_000, 0.05, 1000, 1000, 0)
