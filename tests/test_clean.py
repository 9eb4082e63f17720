"""Expression goldens for the cleaning functions (hand-derived, see FIXTURES.md §2)."""
from pyspark.sql import functions as F

from dirlens.functions import clean as C
from dirlens.functions.classify import classify_first, classify_multi


def one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_company_name(spark):
    assert one(spark, C.clean_company_name,
               ["  Acme   Ltd  Gold ", "Marigold", "Acme Gold Silver", "", None]) == \
        ["Acme Ltd", "Mari", "Acme Gold", "", ""]


def test_country(spark):
    assert one(spark, C.normalize_country,
               ["bd", "xx", "bangladesh", "United States of America", "Germany", None, " BD"]) == \
        ["BD", "XX", "BD", "US", "Germany", "", " BD"]


def test_tier(spark):
    assert one(spark, C.normalize_tier, [" gOLD ", "Bronze", "", None]) == ["Gold", "Unknown", "Unknown", "Unknown"]


def test_clean_text(spark):
    assert one(spark, C.clean_text, [" a \t b\r\nc ", "  ", None, "a b", "a \x00 b"]) == \
        ["a b c", None, None, "a b", "a  b"]


def test_clean_url(spark):
    assert one(spark, C.clean_url, [" https://x.com ", "HTTP://x.com", "x.com", None]) == \
        ["https://x.com", None, None, None]


def test_terms(spark):
    df = spark.createDataFrame([([" Tech", "retail", "Software", "Mining"],), (["tech"],), (None,)],
                               "a array<string>")
    got = [r[0] for r in df.select(C.normalize_industries(F.col("a"))).collect()]
    assert got == [["IT & Technology", "Mining", "Retail"], ["tech"], []]
    df2 = spark.createDataFrame([(["Stock", "crm", "Payroll", "Accounts"],)], "a array<string>")
    assert df2.select(C.normalize_modules(F.col("a"))).first()[0] == ["Accounting", "CRM", "Inventory", "Payroll"]


def test_numbers(spark):
    assert one(spark, C.first_int, ["200+ users", "10 - 50", "none", None]) == [200, 10, 0, 0]
    assert one(spark, C.price_token, ["From $1,200", "free", None]) == ["1", "", ""]
    assert one(spark, C.clean_price, ["From $1,200", "From $1,200.50", "50.0", "free", None]) == \
        [1200.0, 120050.0, 500.0, 0.0, 0.0]
    assert one(spark, C.to_number, ["12", "N/A", None]) == [12.0, 0.0, 0.0]
    assert one(spark, C.sum_matches, ["35 Certified v18, 2 Certified v17", "none"]) == [37, 0]


def test_title_and_lists(spark):
    assert one(spark, C.clean_title, ["Setup & Fix, ODD_1!"]) == ["setup  fix odd_1"]
    assert one(spark, C.primary_value, ["Retail, Food", None]) == ["Retail", "Unknown"]
    assert one(spark, C.title_case, ["crm, erp-setup 2nd"]) == ["Crm, Erp-Setup 2Nd"]
    m = spark.createDataFrame([({"v18": "5"},), ({},)], "m map<string,string>")
    assert [r[0] for r in m.select(C.map_to_text(F.col("m"))).collect()] == ["v18: 5", ""]


def test_format_kpi(spark):
    assert one(spark, C.format_kpi, [1234.0, 100.0, 3.14, 0.25], "double") == ["1,234", "100.0", "3.1", "0.2"]


def test_classify(spark):
    assert one(spark, classify_multi, ["Install API module", "logo", None]) == \
        ["Implementation, Customization, Integration", "Other", "Other"]
    assert one(spark, classify_first, ["Retail manufacturing", "customer service", ""]) == \
        ["Manufacturing", "Services", "General"]


def test_a_text_is_rewritten_once(spark):
    df = spark.createDataFrame([(" a  b ",), ("\x00 \u2003",), ("\x00x\x00",), ("",), (None,)], "t string").select(C.clean_text("t").alias("t"))
    assert [r.t for r in df.collect()] == ["a b", None, "x", None, None]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
