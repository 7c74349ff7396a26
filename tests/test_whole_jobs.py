"""Queries that have to do their whole job: every row in, every row out."""


def _write(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


def test_sql_detection_join_keeps_every_line_item(spark, tmp_path):
    import __spark_entry__ as E
    sf = str(tmp_path)
    _write(spark.createDataFrame([(1, n, 10 + n) for n in range(1, 8)] + [(2, 6, 5)],
                                 "l_orderkey long, l_linenumber int, l_partkey long"), sf, "lineitem")
    _write(spark.createDataFrame([(1, 1), (2, 9)], "o_orderkey long, o_custkey long"), sf, "orders")
    _write(spark.createDataFrame([(1, 3, "MACHINERY")], "c_custkey long, c_nationkey int, c_mktsegment string"), sf, "customer")
    _write(spark.createDataFrame([(3, "CANADA")], "n_nationkey int, n_name string"), sf, "nation")
    got = sorted(tuple(r) for r in E.queries()["sql_detection_join"](spark, sf).collect())
    assert got == [(1, n, 10 + n, "MACHINERY", "CANADA") for n in range(1, 8)] + [(2, 6, 5, None, None)]


def test_papers_and_references_of_one_citekey_are_not_multiplied_out(spark, monkeypatch):
    from pyspark.sql import functions as F
    from scriptorium.plans import paper
    merged = []

    def counted(*args, **kwargs):
        out = merge(*args, **kwargs)
        merged.append(out.count())
        return out
    merge = paper.merge_papers
    monkeypatch.setattr(paper, "merge_papers", counted)
    n = spark.range(40)
    art = n.select(F.concat(F.lit("a:"), F.col("id").cast("string")).alias("_akey"), F.col("id").alias("article_id"),
                   F.lit("c").alias("citekey"), F.lit("x").alias("abstract"), F.lit("2001").alias("year"),
                   F.when(F.col("id") > 0, F.lit("t")).alias("title"), F.lit(3).alias("number_of_pages"),
                   F.lit(0).cast("bigint").alias("journal_pk"))
    ref = n.select(F.lit("c:c").alias("_rkey"), F.lit("c").alias("citekey"),
                   F.concat(F.lit("r"), (F.col("id") % 30).cast("string")).alias("title"), F.lit("1999").alias("year"),
                   F.lit(0).cast("bigint").alias("journal_pk"), F.lit(4).alias("number_of_pages"))
    au = art.select("_akey", F.lit(1).alias("author_position"), F.lit(None).cast("bigint").alias("author_pk"))
    kw = art.select("_akey", F.lit(5).cast("bigint").alias("keyword_pk"))
    ref_au = ref.select("_rkey", F.lit(7).cast("bigint").alias("ref_author_pk")).distinct()
    out = paper.paper_tables((art, kw, au), (ref, ref_au), None)
    assert merged == [39 + 30]  # one row an article; the one without a title has those of the references
    titles = sorted(r.title for r in out["dim_paper"].filter("paper_pk > 0").collect())
    assert titles == sorted(["t"] * 39 + [f"r{i}" for i in range(30)])
    assert sorted(tuple(r) for r in out["bridge_paper_author"].select("author_pk", "author_position").collect()) == [(0, 0), (7, 1)]


def test_entities_are_counted_inside_their_sentence_and_merged_for_repeated_ids(spark):
    from collections import Counter
    from pyspark.sql import functions as F
    from scriptorium.plans import analogue as an
    docs = spark.createDataFrame([(1, "B a b. a\nc C c"), (2, None), (3, ""), (4, "1 2. ..\n"), (5, "x y"), (5, "x x. z"),
                                  (None, "n n"), (None, "n m")], "doc_id long, text string")
    plan = an.entity_counts(an.sentences(docs).select(*an.SENTENCE_KEY, "sentence"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    words = an.sentences(docs).select(*an.SENTENCE_KEY, F.explode(F.regexp_extract_all("sentence", F.lit(r"\p{L}+"), 0)).alias("w"))
    want = Counter((*r[:3], r.w.lower()) for r in words.collect())
    got = an.detections(docs).collect()
    assert {(r.doc_id, r.line_no, r.sent_no, r.entity_name): r.entity_count for r in got} == dict(want)
    assert len(got) == len(want) and want[(5, 0, 0, "x")] == 3 and want[(None, 0, 0, "n")] == 3


def test_facts_meet_sentences_that_have_met_their_paragraphs(spark):
    from scriptorium.plans.paper_summary import warehouse_detections
    fact = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (9, 1, 1), (2, 8, 4)], "entity_pk long, sentence_pk long, entity_count long")
    ent = spark.createDataFrame([(1, "L", "a"), (2, "M", "b")], "entity_pk long, entity_label string, entity_name string")
    sent = spark.createDataFrame([(1, "BODY", 5), (2, "BODY", 6)], "sentence_pk long, sentence_type string, paragraph_pk long")
    para = spark.createDataFrame([(5, 7, "H", "T")], "paragraph_pk long, paper_pk long, heading string, paragraph_type string")
    out = warehouse_detections(fact, ent, sent, para)
    assert sorted(map(str, out.select("paper_pk", "sentence_pk", "heading", "entity_count", "entity_name").collect())) == sorted([
        "Row(paper_pk=7, sentence_pk=1, heading='H', entity_count=2, entity_name='a')",
        "Row(paper_pk=None, sentence_pk=2, heading=None, entity_count=3, entity_name='a')",
        "Row(paper_pk=None, sentence_pk=8, heading=None, entity_count=4, entity_name='b')"])
    facts = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert len(facts) == 3 and "LeftOuter" in facts[0] and "Inner" in facts[1] and "LeftOuter" in facts[2]


def _reads_only(df):
    """Whether a plan reads stored rows without joining anything again."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "Join" not in plan and "Relation" in plan


def test_members_and_bridges_of_papers_are_made_once(spark):
    from scriptorium.plans import paper
    named = lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)
    papers = named("article_id long, citekey string, title string, abstract string, year string, number_of_pages string, journal string, "
                   "journal_akronym string, publisher string, place string, volume string, issue string, keywords string, authors string",
                   (1, "c", "t", "x", "2001", "3", *[None] * 8))
    keywords = named("article_id long, keyword string", (1, "K"), (1, "k"), (2, "l"), (None, "l"))
    authors = named("article_id long, fullname string, author_position int", (1, "Doe, Ann", 2), (1, "Doe, Ann", 2), (3, "Roe", 1))
    dim_keyword = named("keyword_pk long, keyword_string string", (1, "k"), (2, "l"))
    dim_author = named("author_pk long, surname string, firstname string, middlename string", (1, "Doe", "Ann", "MISSING"))
    dim_journal = named("journal_pk long, title string, volume int, issue int, publisher string, place string", (7, "j", 0, 0, "p", "q"))
    one, kw, au = paper.article_parts(papers, keywords, authors, dim_keyword, dim_author, dim_journal)
    assert _reads_only(kw) and _reads_only(au)
    assert sorted(map(tuple, kw.collect())) == [("a:1", 1), ("a:2", 2), ("none", 2)]
    assert sorted(map(tuple, au.collect())) == [("a:1", 2, 1), ("a:3", 1, None)]
    assert sorted((r._akey, r.article_id) for r in one.collect()) == [("a:1", 1), ("a:2", 2), ("a:3", 3), ("none", None)]
    ref = named("_rkey string, citekey string, title string, year string, journal_pk long, number_of_pages int", ("c:r", "r", "t", "1999", 0, 4))
    ref_au = named("_rkey string, ref_author_pk long", ("c:r", 9))
    tables = paper.paper_tables((one, kw, au), (ref, ref_au), None)
    for name in ("dim_keywordgroup", "bridge_paper_keyword", "dim_authorgroup", "bridge_paper_author"):
        assert _reads_only(tables[name]), name
    assert {t: df.count() for t, df in tables.items()} == {
        "dim_keywordgroup": 4, "bridge_paper_keyword": 5, "dim_authorgroup": 4, "bridge_paper_author": 4, "dim_paper": 6}


def test_a_fact_delta_meets_its_target_once(spark):
    from scriptorium.operators.delta import stored_fact_delta
    source = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7), (None, 1, 8)], "a long, b long, n long")
    target = spark.createDataFrame([(1, 1, 5), (1, 2, 9), (3, 3, 1)], "a long, b long, n long")
    new, changed = stored_fact_delta(source, target, ["a", "b"], "n")
    assert _reads_only(new) and _reads_only(changed)
    assert sorted(map(tuple, new.collect()), key=str) == [(2, 1, 7), (None, 1, 8)]
    assert list(map(tuple, changed.collect())) == [(1, 2, 6, 9)]
    assert changed.columns == ["a", "b", "n", "previous_n"]


def test_sources_of_small_files_are_dealt_out(spark):
    from scriptorium.queries_load import _part_sources
    sources = _part_sources(spark, "/root/testdata/sf0.001", True)
    for name in ("entities.csv", "papers_final.csv", "unique_references.csv"):
        assert "RepartitionByExpression" in sources[name]._jdf.queryExecution().optimizedPlan().toString()


def test_aggregation_paper_works_in_parts_and_frees_their_disk(spark, tmp_path, monkeypatch):
    import glob
    import __spark_entry__ as E
    from scriptorium import bindings
    from scriptorium.operators import skew
    from scriptorium.session import SPARING, ensure_checkpoint_dir
    words = "alpha beta gamma delta 12 sampling 0.5 epsilon participants theta 7 iota kappa lambda eleven mu".split()
    docs = [(i % 23 if i < 30 else None, "src", "en", "\n".join(". ".join(" ".join(
        words[(i * j + k) % len(words)] for k in range(j % 6 + 1)) for j in range(i % 4 + 2)) for _ in range(i % 3 + 1))) for i in range(32)]
    _write(spark.createDataFrame(docs, "doc_id long, source string, lang string, text string"), str(tmp_path), "documents")
    made = {}

    def counted(store):
        def run(parts, name="stage"):
            frames = list(parts)
            made[name] = len(frames)
            return store(frames, name)
        return run
    run = lambda: sorted(map(tuple, E.queries()["aggregation_paper"](spark, str(tmp_path)).collect()), key=str)
    whole = run()
    assert len(whole) == 31  # the papers with an id, and the unknown one
    before = {key: spark.conf.get(key, None) for key in SPARING}
    tables = lambda name: {*glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/tables/{name}-*")}
    were = {name: tables(name) for name in ("facts", "named_facts", "places", "votes")}
    assert not were["facts"] and not were["places"] and were["votes"]
    monkeypatch.setattr(skew, "PART_ROWS", 400)
    monkeypatch.setattr(bindings, "materialize_parts", counted(bindings.materialize_parts))
    assert run() == whole
    assert made["sentences"] > 1 and made["facts"] > 1
    assert not tables("facts") and not tables("named_facts") and not tables("places")
    assert {key: spark.conf.get(key, None) for key in SPARING} == before
    voted = spark.createDataFrame([(i % 5 if i % 7 else None, i) for i in range(100)], "paper_pk long, n int")
    parts = [voted.filter(p) for p in skew.part_filters(voted, "paper_pk", 40)]
    assert len(parts) == 3 and sorted(r.n for p in parts for r in p.collect()) == list(range(100))


def test_headings_are_matched_with_their_paragraph(spark):
    from pyspark.sql import functions as F
    from scriptorium.functions.weights import LABELS, heading_hits, rule_weight, sentence_weight
    names = ["data collection method", "sampling", "theory", "validity", "other", None]
    heads = ["Data", "Methods", "    x", "Results", "Testing", "none", None]
    rows = [(lab, n, c, t, h) for lab in [*LABELS, "X", None] for n in names for c in (1, 3, None) for t in ("ABSTRACT", "BODY", None) for h in heads]
    df = spark.createDataFrame(rows, "entity_label string, entity_name string, entity_count long, sentence_type string, heading string")
    args = ("entity_label", "entity_name", "entity_count", "sentence_type", "heading")
    out = df.withColumns({"hits": heading_hits("heading"), "w": rule_weight(*args), "ws": rule_weight(*args, for_sentence=True)}) \
        .withColumn("w2", rule_weight(*args, hits="hits")).withColumn("ws2", sentence_weight(*args[:3], "w2"))
    assert out.count() == len(rows) and out.filter(~F.col("w").eqNullSafe(F.col("w2")) | ~F.col("ws").eqNullSafe(F.col("ws2"))).isEmpty()


def test_sources_of_a_full_load_are_read_once_and_in_pieces(spark, tmp_path):
    from scriptorium.queries_load import derived_sources
    sf, line = str(tmp_path), "The cat. A Cat the\nend"
    docs = [(i % 40, line + f" w{chr(97 + i % 26)}", "en", "web", 10 * i) for i in range(60)] + [(None, line, "es", "web", 1)] * 2 + [(99, None, "en", "x", 0)]
    _write(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1), sf, "documents")
    _write(spark.createDataFrame([(i, "red fox", "TYPE", "B", i) for i in range(1, 9)],
                                 "p_partkey long, p_name string, p_type string, p_brand string, p_size int").coalesce(1), sf, "part")
    _write(spark.createDataFrame([(1, 1, 1, 1), (1, 2, 9, 2), (None, 3, 4, 3), (2, 4, None, 1)],
                                 "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int"), sf, "lineitem")
    _write(spark.createDataFrame([(1, 0), (2, 1), (4, None)], "s_suppkey long, s_nationkey int"), sf, "supplier")
    _write(spark.createDataFrame([(0, "PERU"), (1, "CHILE")], "n_nationkey int, n_name string"), sf, "nation")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # small pieces are merged
    spark.conf.set(merging, "false")
    try:
        sources = derived_sources(spark, sf)
    finally:
        spark.conf.set(merging, "true")
    for name in ("keywords.csv", "authors.csv", "unique_references.csv"):
        assert _reads_only(sources[name]), name
    assert len(sources["papers_final.csv"].inputFiles()) > 1  # one row group was read by one task
    words = {(d[0], w) for d in docs if d[1] for w in d[1].replace(".", "").split()}
    got = [tuple(r) for r in sources["keywords.csv"].select("article_id", "keyword").collect()]
    assert len(got) == len(words) and set(got) == words
    assert sources["papers_final.csv"].count() == 63 and sources["authors.csv"].count() == 4
    assert sources["unique_references.csv"].count() == 8


def test_names_are_cleaned_by_spelling_not_by_row(spark):
    from scriptorium.operators.mode import attribute_votes, mode_per_attribute
    from scriptorium.plans import author, paper
    rows = [(i % 3, "Doe, Ann" + ("1" if i % 4 == 0 else ""), "a@x" if i % 5 else None, "d", None, "PERU" if i % 3 else "CHILE", i % 2) for i in range(24)]
    rows += [(7, None, "n@x", "d", "i", None, 1), (8, "Roe", None, None, None, None, 1), (8, "(Roe)", "r@x", None, None, None, 2)]
    src = spark.createDataFrame(rows, "article_id long, fullname string, email string, departments string, institutions string, countries string, author_position int")
    counted = attribute_votes(src, ["fullname"], ["email", "countries"])
    assert counted.count() < 24 and counted.filter("_attr = 'email'").groupBy().sum("_n").first()[0] == len(rows)
    a = author.split_names(src.withColumnsRenamed({"departments": "department", "institutions": "institution", "countries": "country"}))
    whole = mode_per_attribute(mode_per_attribute(a, ["fullname"], author.ATTRS, first_cols=author.NAME).drop("fullname"), author.NAME, author.ATTRS)
    got = author.conform_authors(src)
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(map(str, whole.collect())) and got.count() == 3
    named = lambda ddl, *r: spark.createDataFrame(list(r), ddl)
    papers = named("article_id long, citekey string, title string, abstract string, year string, number_of_pages string, journal string, "
                   "journal_akronym string, publisher string, place string, volume string, issue string, keywords string, authors string")
    dim_author = named("author_pk long, surname string, firstname string, middlename string", (0, *["MISSING"] * 3), (5, "Doe", "Ann", "MISSING"))
    _, _, au = paper.article_parts(papers, named("article_id long, keyword string"), src, named("keyword_pk long, keyword_string string"), dim_author,
                                   named("journal_pk long, title string, volume int, issue int, publisher string, place string"))
    assert sorted(map(str, map(tuple, au.collect()))) == sorted(map(str, {
        (f"a:{r[0]}", r[6], 0 if r[1] is None else 5 if "Doe" in r[1] else None) for r in rows}))
