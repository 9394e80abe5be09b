import duckdb
import pytest

SF = "/root/testdata/sf0.001"
WIDE = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, size int, component_id string, spans string, _text string, row string, _id int"


@pytest.fixture(scope="session")
def raw():
    """Rows of a table of sf0.001, as tuples."""
    def rows(sql: str) -> list[tuple]:
        c = duckdb.connect()
        for t in ("documents", "pages", "benchmark"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        return c.execute(sql).fetchall()
    return rows


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table, with further columns whose names the operators use themselves, from (doc_id, text[, source])."""
    def make(rows):
        full = [(i, t, "en", src[0] if src else "s", None if t is None else len(t), True, 7, "x", "y", "z", "w", 3) for i, t, *src in rows]
        return spark.createDataFrame(full, WIDE).repartition(3)
    return make
