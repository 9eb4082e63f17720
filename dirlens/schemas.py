"""Explicit schemas for every entity (library code never infers a schema)."""

from pyspark.sql import types as T

S = T.StringType()

PROVIDER_RAW = T.StructType([
    T.StructField("provider_id", S),
    T.StructField("name", S),
    T.StructField("country", S),
    T.StructField("location", S),
    T.StructField("tier", S),
    T.StructField("website", S),
    T.StructField("description", S),
    T.StructField("services", T.ArrayType(S)),
    T.StructField("client_references", T.ArrayType(S)),
    T.StructField("source_url", S),
])

ENVELOPE_METADATA = T.StructType([
    T.StructField("country_code", S),
    T.StructField("scrape_date", S),
    T.StructField("total_records", T.LongType()),
    T.StructField("scraper_version", S),
])


def envelope_schema(field: str = "providers", record: T.StructType = PROVIDER_RAW) -> T.StructType:
    return T.StructType([
        T.StructField("metadata", ENVELOPE_METADATA),
        T.StructField(field, T.ArrayType(record)),
    ])


CLIENT_REFERENCE = T.StructType([
    T.StructField("client_name", S),
    T.StructField("description", S),
    T.StructField("modules_implemented", T.ArrayType(S)),
    T.StructField("outcomes", S),
])

PARTNER_DETAILED = T.StructType([
    T.StructField("company_name", S),
    T.StructField("tier", S),
    T.StructField("website", S),
    T.StructField("city", S),
    T.StructField("partner_id", S),
    T.StructField("average_project_size", S),
    T.StructField("large_project_size", S),
    T.StructField("certified_experts", S),
    T.StructField("reference_count_listed", S),
    T.StructField("certifications", T.MapType(S, S)),
    T.StructField("client_references_detailed", T.ArrayType(CLIENT_REFERENCE)),
])

GIG = T.StructType([
    T.StructField("title", S),
    T.StructField("seller_name", S),
    T.StructField("price", S),
    T.StructField("link", S),
])

# Flattened partner/client export, in its declared column order (K4).
FLAT_CLIENT_COLUMNS = [
    "Partner Name", "Partner Tier", "Client Name", "Client Industry",
    "Modules Implemented", "Key Outcomes", "Project Description",
    "Partner Website", "Partner City", "Partner ID",
    "Avg Project Size", "Large Project Size", "Certified Experts",
    "Total References Listed", "Certifications",
]

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", S),
    T.StructField("html", S),
])
