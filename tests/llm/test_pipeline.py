import inspect

import corpus_pipeline
from nearfold.llm import queries
from tests.llm.helpers import LONG, awkward, table

SF = "/root/testdata/sf0.01"


def test_stages_hand_on_documents(spark, tmp_path):
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sizes = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / str(i))
        stage(spark, docs, SF).write.parquet(out)
        result = spark.read.parquet(out)
        sizes.append(result.count())
        if i < 4:
            assert result.columns == docs.columns and [f.dataType for f in result.schema] == [
                f.dataType for f in docs.schema
            ]
            docs = result
    assert sizes[0] > 980 and sizes[1] < sizes[0] and sizes[2] < sizes[1] and sizes[3] == sizes[2]
    hidden = [r for r in docs.collect() if r.text != texts[r.doc_id]]
    assert hidden and all("[SECRET]" in r.text and r.n_chars == len(r.text) for r in hidden)
    passages = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert not any(p in r.text for r in docs.collect() for p in passages)
    packed = result.toPandas()
    assert set(packed.doc_id) == {r.doc_id for r in docs.collect()}


def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).where("doc_id = 5").agg({"n_tokens": "sum"}).head()[
        0
    ] == len(LONG.split()) + 1


def test_run(spark, sf_small):
    assert corpus_pipeline.run(spark, sf_small).count() > 100
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_queries_equal_sql(spark):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    for name, sql in queries.oracle_sql().items():
        got, want = queries.queries()[name](spark, SF).toArrow(), con.sql(sql).to_arrow_table()
        columns = sorted(got.column_names)
        order = [(c, "ascending") for c in columns]
        assert columns == sorted(want.column_names)
        assert got.select(columns).sort_by(order).to_pylist() == want.select(columns).sort_by(order).to_pylist()


def test_every_query_covers_its_table(spark, sf_small):
    rows = {
        "op1_compression_language": 200, "op2_bounded_ring": 200, "op4_salvaged_archive": None,
        "op7_simhash_ball": 200, "op8_owned_secrets": 200, "op9_backoff_automaton": 200,
        "op10_feistel_pseudonyms": 200, "op12_hashed_alignment": 200, "op13_batched_bpe": 200,
    }
    found = queries.queries()
    assert [int(n[2:].split("_")[0]) for n in found] == list(range(1, 14))
    for name, expected in rows.items():
        if expected is None:
            expected = table(spark, sf_small, "pages").count()
        assert found[name](spark, sf_small).count() == expected, name
    assert ".limit(" not in inspect.getsource(queries)


def test_whole_pipeline_equals_brute_force(spark, sf_small):
    """Every stage again over plain rows: who stays, which text, and how it is packed."""
    import re
    from collections import Counter, defaultdict

    from nearfold.llm.langid import MARGIN, Classifier, fit_dictionaries
    from tests.llm.test_decontam import equal_by_definition
    from tests.llm.test_packing import unrolled
    from tests.llm.test_secrets import REFERENCE
    from tests.llm.test_simhash import plain_components, plain_fingerprint

    table_ = table(spark, sf_small, "documents")
    rows = {r.doc_id: r.asDict() for r in table_.collect()}
    classifier = Classifier(fit_dictionaries(table_))
    kept = {}
    for key, row in rows.items():
        language, _, margin = classifier.predict(row["text"])
        if language != "und" and margin >= MARGIN:
            kept[key] = row
    prints = {key: plain_fingerprint(row["text"]) for key, row in kept.items()}
    groups, least = plain_components(prints.values()), {}
    for key, value in prints.items():
        group = min(groups[value])
        least[group] = min(key, least.get(group, key))
    kept = {key: row for key, row in kept.items() if key == least[min(groups[prints[key]])]}
    words = lambda t: re.findall(r"\w+", t.lower())
    items = [words(r.text) for r in table(spark, sf_small, "benchmark").collect()]
    # Items are compared only where a word run of four is shared: no alignment without one can leak.
    runs = [{tuple(i[n : n + 4]) for n in range(len(i) - 3)} for i in items]

    def leaks_(text):
        found = words(text)
        mine = {tuple(found[n : n + 4]) for n in range(len(found) - 3)}
        return any(mine & run and equal_by_definition(found, item) for item, run in zip(items, runs, strict=True))

    kept = {key: row for key, row in kept.items() if not leaks_(row["text"])}
    owners = defaultdict(set)
    for row in kept.values():
        for pattern, group, size, flags in REFERENCE.values():
            for m in re.finditer(pattern, row["text"], flags):
                if len(m.group(group)) >= size:
                    owners[m.group(group)].add(row["source"])
    live = {v for v, o in owners.items() if len(o) <= 2 and len(set(v)) >= 6}
    histogram, pieces = Counter(), Counter()
    for key, row in kept.items():
        text = row["text"]
        for pattern, group, _, flags in REFERENCE.values():
            text = re.sub(
                pattern,
                lambda m, group=group: m.group()[: len(m.group()) - len(m.group(group))] + "[SECRET]"
                if m.group(group) in live else m.group(),
                text, flags=flags,
            )
        tokens = len(re.findall(r"[^\x20\x09-\x0D]+", text)) + 1
        for piece, begin in enumerate(range(0, tokens, 4096)):
            pieces[key, piece, min(4096, tokens - begin)] += 1
            histogram[min(4096, tokens - begin)] += 1
    got = corpus_pipeline.run(spark, sf_small).collect()
    assert Counter((r.doc_id, r.piece, r.n_tokens) for r in got) == pieces
    bins, sizes = unrolled(dict(histogram), (512, 1024, 2048, 4096))
    mine = defaultdict(list)
    for r in got:
        mine[r.bin].append((r.bin_offset, r.n_tokens))
        assert r.bin_length == sizes[r.bin]
    assert {b: sorted(v) for b, v in mine.items()} == {b: sorted(v) for b, v in bins.items()}
    assert len(kept) > 100
