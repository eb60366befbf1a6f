"""Each stage keeps the columns of documents, and the last packs what the others kept."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline

from test_llm import fingerprint, lower, roots

from assetpulse.llm import mixing

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs, kept = spark.read.parquet(str(tmp_path / name)), docs
        if name != "packing":
            assert docs.columns == columns and 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()


def test_columns_of_any_name_pass_through(spark, tmp_path):
    """Columns named like the stages' own, or like Spark's hidden one, keep their values."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["_at", "_file", "_key", "_row", "quality_score", "_metadata", "fp", "keep_id", "component_id", "group_size", "kept", "sequence_id", "row"]
    docs.selectExpr("*", *[f"-7.5D * (doc_id + {n}) AS `{c}`" for n, c in enumerate(names)]).write.parquet(str(tmp_path / "docs"))
    wide = spark.read.parquet(str(tmp_path / "docs"))
    for name, stage in pipeline.STAGES[:4]:
        rows = stage(spark, wide, SF)
        assert rows.columns == wide.columns, name
        got = rows.collect()
        assert got and all(r[c] == -7.5 * (r["doc_id"] + n) for r in got for n, c in enumerate(names)), name
        plain = stage(spark, docs, SF)
        assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in plain.collect()), name
        assert stage(spark, wide.limit(0), SF).count() == 0


def dealt(offers, weights, budget):
    """Budgets of sibling nodes by plain water filling: whoever offers less than its part gives all, until nobody does."""
    got, rest = {}, dict(offers)
    while rest:
        per = budget / sum(weights.get(n, 1.0) for n in rest)
        small = {n: o for n, o in rest.items() if o <= per * weights.get(n, 1.0)}
        if not small:
            return got | {n: per * weights.get(n, 1.0) for n in rest}
        got |= small
        budget -= sum(small.values())
        rest = {n: o for n, o in rest.items() if n not in small}
    return got


def test_mixing_meets_its_budgets(spark):
    """Leaf totals are those of a plain budget over domain, language and source; a hot source loses its share."""
    names = ["src0"] * 300 + ["src1"] * 100 + ["src11"] * 60 + ["src12"] * 4 + ["wiki"] * 40
    rows = [(i, "word " * (20 + i % 7), ("en", "fr", "de")[i % 3], s, 0) for i, s in enumerate(names)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    tokens = {r[0]: -(-len(r[1]) // 4) for r in rows}
    domain = {"src0": "web", "src1": "web", "src11": "curated", "src12": "curated", "wiki": "other"}
    leaf = {r[0]: (domain[r[3]], r[2], r[3]) for r in rows}
    total, want = defaultdict(int), {(): mixing.SHARE * sum(tokens.values())}
    for i, path in leaf.items():
        total[path] += tokens[i]
    for depth in range(3):
        for above, budget in list(want.items()):
            if len(above) == depth:
                offers = defaultdict(float)
                for path, t in total.items():
                    if path[:depth] == above:
                        offers[path[depth]] += t
                weights = {path[-1]: w for path, w in mixing.WEIGHTS.items() if len(path) == depth + 1}
                want |= {(*above, n): b for n, b in dealt(offers, weights, budget).items()}
    got, times = defaultdict(int), defaultdict(int)
    for r in pipeline.sources(spark, df, SF).collect():
        got[leaf[r["doc_id"]]] += tokens[r["doc_id"]]
        times[r["doc_id"]] += 1
    for path in total:
        assert want[path] - 1e-6 <= got[path] <= want[path] + max(tokens.values()), path
    assert max(times.values()) == 1 and len(times) < len(rows)
    share = sum(t for p, t in got.items() if p[2] == "src0") / sum(got.values())
    assert share < 0.9 * sum(tokens[r[0]] for r in rows if r[3] == "src0") / sum(tokens.values())


def one_each(rows, group, best):
    """One row of each group by plain choice: ids before nulls, the best id; which of equal ids is left open."""
    groups = defaultdict(list)
    for r in rows:
        groups[group(r)].append(r)
    return {g: best((r["doc_id"] for r in own if r["doc_id"] is not None), default=None) for g, own in groups.items()}


def test_run_keeps_one_row_of_each_group(spark, tmp_path):
    """Null and repeated ids: the two stages alone, and the ids that run() packs."""
    good = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 400").orderBy("doc_id").limit(12).collect()]
    ids = [None, None, 1, 1, 2, 3, 3, None, 4, 5, 5, None, None, 6, 7, 7]
    texts = [0, 1, 2, 2, 3, 3, 4, 4, 5, 6, 7, 8, 8, 9, 9, 10]
    rows = [(i, good[t] if n % 3 else good[t].upper(), "en", f"src{n % 3}", n) for n, (i, t) in enumerate(zip(ids, texts, strict=True))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for df in (docs, docs.union(docs.limit(0))):  # from files, and not
        got = pipeline.exact(spark, df, "").collect()
        want = one_each(docs.collect(), lambda r: lower(r["text"]), max)
        assert Counter((lower(r["text"]), r["doc_id"]) for r in got) == Counter(want.items())
    pipeline.exact(spark, docs, "").write.parquet(f"{tmp_path}/exact")
    kept = spark.read.parquet(f"{tmp_path}/exact")
    for df in (kept, docs):
        own = df.collect()
        prints = {lower(r["text"]): fingerprint(r["text"]) for r in own}
        near = [(a, b) for a in prints.values() for b in prints.values() if (a ^ b).bit_count() <= 4]
        root = roots(near, set(prints.values()))
        want = one_each(own, lambda r: root[prints[lower(r["text"])]], min)
        got = pipeline.simhash(spark, df, "").collect()
        assert Counter((root[prints[lower(r["text"])]], r["doc_id"]) for r in got) == Counter(want.items())
    quality, mix = pipeline.STAGES[0], pipeline.STAGES[3]
    every = [(n, (lambda s, d, _: d) if n in (quality[0], mix[0]) else f) for n, f in pipeline.STAGES]
    stages, pipeline.STAGES = pipeline.STAGES, every  # the other stages may drop any row
    try:
        packed = Counter(r["doc_id"] for r in pipeline.run(spark, str(tmp_path)).where("piece = 0").collect())
    finally:
        pipeline.STAGES = stages
    assert packed == Counter(r["doc_id"] for r in pipeline.simhash(spark, kept, "").collect()) and packed[None] > 0
