import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import augment_queries, choice_queries, cleaning_queries, dataset_queries, evaluation_queries, file_queries, group_queries, more_queries, queries, stream_queries  # noqa: F401
from tests.conftest import SF, plain


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(name, same):
    same(name)


@pytest.mark.parametrize("name", sorted(queries.QUERIES.keys() - queries.ORACLE.keys()))
def test_runs(name, spark):
    assert queries.QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() == 4


def test_columns_agree():
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_near_pairs_and_coco_match_have_no_product(spark):
    for name in ("near_dupes", "coco_image_match"):
        p = plan(queries.QUERIES[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(queries.QUERIES["top_fp"](spark, SF))


def test_scan_reads_two_columns(spark):
    p = plan(queries.QUERIES["split_counts"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint>" in p or "text" not in p.split("ReadSchema")[-1]


def test_clean_images_count_every_box_issue(spark):
    found = queries._boxes_judged(spark, SF).selectExpr("sum(size(issues)) AS n").first().n
    codes = queries.clean_images(spark, SF).selectExpr("explode(split(issues, ',')) AS c")
    assert codes.where("c IN ('bbox_too_small', 'bbox_too_large', 'unusual_aspect_ratio')").count() == found


def test_ocr_line_order_has_every_line(spark, duck):
    want = duck.sql("SELECT user_id, string_agg(event_type, '' ORDER BY (event_id * 31) % 480, event_id) FROM events GROUP BY user_id").fetchall()
    assert sorted(tuple(r) for r in queries.QUERIES["ocr_line_order"](spark, SF).collect()) == sorted(want)


def test_box_duplicates_where_ids_meet_their_twins(spark, tmp_path):
    con, path = duckdb.connect(), f"{tmp_path}/events.parquet"
    # the twin of a box has the id of the next copy's; some boxes have no image
    con.sql(f"COPY (SELECT * REPLACE (event_id + k * 1000000 AS event_id, CASE WHEN event_id % 97 > 0 THEN user_id END AS user_id) FROM '{SF}/events.parquet', (SELECT unnest(range(3)) AS k)) TO '{path}' (FORMAT parquet)")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{path}'")
    want = con.sql(entry.oracle_sql()["box_duplicates"]).to_arrow_table()
    assert plain(entry.queries()["box_duplicates"](spark, str(tmp_path)).toArrow()) == plain(want) and want.num_rows > 2000
