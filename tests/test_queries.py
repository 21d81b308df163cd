"""Every query against its DuckDB oracle on the smallest tables, and the driver's entry points."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__
from lodestone.queries.catalogue import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_oracle(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    want = duck.sql(ORACLE[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    spark.catalog.clearCache()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_has_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.columns == ["source_id", "sentences", "skipped", "claims", "weight"]


def test_oracles_belong_to_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


#: Texts on which Unicode's white space, digits, edges of words and lower case give other sentences or scores than the SQL's.
ODD = (
    "It was é1997. It is 2024é", "Costs 5 mté. Costs 50%é! Costs 5 kt", "Only ٣.٤ remain. In １９９７", "One.\x1c Two!\x0b ", "a\x0bb: \x1f.  > cited.    \nx:　",
    " References. ", "\u0085References. Table 3. Section 4-5:. Fıgure 1. ſection 2", "7 tonneſ. 7 tonneſa! 7 Kt. 7 mıllion", "He fİnds it. We muſt go", "\x1c'Quoted.'  \"x\"", "Rose to $ 5. Rose to $\t5. 1.5",
)


def test_document_claims_of_odd_texts_equal_oracle(spark, tmp_path):
    rows = [(i, t, f"s{i}") for i, t in enumerate((*ODD, None, "", " \n"))]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(tuple(map(plain, r)) for r in QUERIES["document_claims_by_source"](spark, str(tmp_path)).collect())
    assert got == sorted(tuple(map(plain, r)) for r in con.sql(ORACLE["document_claims_by_source"]).fetchall())
    assert len(got) == len(ODD)


@pytest.mark.parametrize("name", ["sentence_offsets", "sentence_counts_by_lang", "conversation_sentences"])
def test_sentences_of_odd_texts_equal_oracle(name, spark, tmp_path):
    rows = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(ODD)], "doc_id long, text string, lang string").coalesce(1)
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    rows.selectExpr("doc_id AS conv_id", "0L AS turn", "lang AS role", "text").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df, want = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLE[name])
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(tuple(map(plain, r)) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
