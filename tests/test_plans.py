"""Plan shape: filters reach the scan, columns are pruned, no Python in the cleaning path."""
import contextlib
import io

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_pushdown(spark):
    # only returned lines count as done
    assert "EqualTo(l_returnflag,R)" in plan(E.queries()["f07_skip_done"](spark, SF))


def test_pruning(spark):
    # the join counts read lineitem whole, with the key alone
    p = plan(E.queries()["j01_left_join_counts"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint>" in p and "l_quantity" not in p
    # the provider view reads lineitem whole, with only the columns it needs
    p = plan(E.queries()["c01_clean_providers"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_no_python_in_cleaning_and_scoring(spark):
    for name in ("c01_clean_providers", "q04_score_providers", "c13_classify_multi", "c12_clean_title",
                 "a08_grand_kpis", "n02_flatten_dedup_sort"):
        p = plan(E.queries()[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p, name


def test_pages_single_python_pass(spark):
    p = plan(E.queries()["h01_links"](spark, SF))
    assert p.count("MapInPandas") >= 1 and "BatchEvalPython" not in p
    assert "ReadSchema: struct<page_id:bigint,url:string,html:string>" in p


def test_flattened_partners_are_not_dealt_out_again(spark):
    from dirlens.operators.nested import flatten_dedup_sort
    from dirlens.plans.bindings import partner_pages
    plan = flatten_dedup_sort(partner_pages(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" in plan and "hashpartitioning(Partner ID" not in plan
