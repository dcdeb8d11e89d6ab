"""Columns that SQL can express of queries that it can't express whole."""

import duckdb
import pytest

from folio.llm import queries

SF = "/root/testdata/sf0.01"
KEY = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
SQL = {
    "op4_secret_scan": f"""SELECT doc_id, len(list_filter(regexp_extract_all(coalesce(text, ''), '{KEY.replace("'", "''")}', 1), lambda x: length(x) >= 12)) AS n_assign,
      len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda x: length(x) >= 18)) AS n_access, len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda x: length(x) >= 16)) AS n_hex FROM documents""",
    "op5_fingerprints": """SELECT doc_id, n AS n_chars, sha256(left(t, n - n // 2) || left(next, n // 2)) AS edited_sha256 FROM (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
      coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next FROM documents)""",
    "op9_quality": "SELECT doc_id FROM documents",
    "op11_language": "SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), '\\p{L}') THEN '' ELSE 'und' END AS unknown FROM documents",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_columns(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(SQL[name])
    columns = [d[0] for d in want.description]
    got = queries.queries()[name](spark, SF)
    if name == "op11_language":
        got = got.selectExpr("doc_id", "if(lang_pred = 'und', 'und', '') AS unknown")
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
