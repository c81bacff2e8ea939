"""Every registered query against its SQL on the smallest tables, and under another number of partitions."""

import duckdb
import pytest

from inkspring.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name):
    cols, got = rows_of(QUERIES[name](spark, sf))
    if name in ORACLES:
        cur = db.execute(ORACLES[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert got == sorted(repr([plain(r[i]) for i in at]) for r in cur.fetchall())
    else:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        try:
            assert rows_of(QUERIES[name](spark, sf)) == (cols, got)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_names_are_counted_as_in_sql(spark, tmp_path):
    texts = ["Thnd, THND!", "th nd", "th-nd", "thnd thnd", "thnd  thnd thnd", "thnd_", "_thnd", "thnd\n", "\r\nthnd\r\n", "thnd\u0301", "\u203fthnd\u203f", "athnd", "thnd2", "中thnd", "", None]
    rows = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "conv_id long, turn long, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["T1_find_all"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(ORACLES["T1_find_all"]).fetchall())


def test_entry_works_without_the_corpus_package(monkeypatch):
    import __spark_entry__ as entry

    real = entry.importlib.import_module

    def gone(name, *a):
        if name.startswith(("inkspring.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named '{name}'", name=name)
        return real(name, *a)

    monkeypatch.setattr(entry.importlib, "import_module", gone)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)
