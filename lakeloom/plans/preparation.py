"""Preparation of census-like and product tables from the single operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import scalars as fn
from lakeloom.operators import columns as C
from lakeloom.operators.joins import left_join_on
from lakeloom.operators.rows import sentinel_dropna, split_random
from lakeloom.plans.registry import Tables, hash_sql, query, train_sql
from lakeloom.sources.synthetic import choice_column

# fixed values: school levels and the group each belongs to
EDUCATION = {
    "preschool": "elementary",
    "1st-4th": "elementary",
    "5th-6th": "elementary",
    "7th-8th": "elementary",
    "9th": "middle",
    "10th": "middle",
    "11th": "middle",
    "12th": "middle",
    "some-college": "undergraduate",
    "bachelors": "undergraduate",
    "assoc-acdm": "undergraduate",
    "assoc-voc": "undergraduate",
    "prof-school": "graduate",
    "masters": "graduate",
    "doctorate": "graduate",
}
UNDEFINED_WORK = ("never-worked", "without-pay", "?")
OTHER_WORK = ("?", "other-service")


def clean_text_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: fn.strip_lower(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)})


def group_levels(df: DataFrame) -> DataFrame:
    """School levels, home country and class of work in few groups each."""
    return df.withColumns(
        {
            "education": fn.recode("education", EDUCATION),
            "native_country": fn.recode_else(fn.recode("native_country", {"united-states": "us"}), ["us"], "non-us"),
            "workclass": fn.recode("workclass", dict.fromkeys(UNDEFINED_WORK, "undefined")),
        }
    )


def group_occupations(df: DataFrame) -> DataFrame:
    """Unclear occupations become ``other``, those of (under)graduates ``other-2``."""
    df = df.withColumn("occupation", fn.recode("occupation", dict.fromkeys(OTHER_WORK, "other")))
    studied = F.col("education").contains("graduate") & (F.col("occupation") == "other")
    return df.withColumn("occupation", fn.with_suffix_when("occupation", studied, "-2"))


def prepare_census(df: DataFrame) -> DataFrame:
    kept = C.drop_matching(df, "capital|num|fnlwgt")
    return sentinel_dropna(group_occupations(group_levels(clean_text_columns(kept))))


LEVELS = [*EDUCATION, "hs-grad"]
COUNTRIES = ["United-States", "Poland", "?"]
WORK = ["Private", "Without-pay", "?", "State-gov"]
JOBS = ["?", "Other-service", "Clerk", "Sales"]


def census(t: Tables) -> DataFrame:
    """Customers with census columns drawn from their key."""
    key = ["c_custkey"]
    return t.customer.select(
        "c_custkey",
        F.concat(F.lit(" "), F.initcap(choice_column(key, LEVELS, 21))).alias("education"),
        choice_column(key, COUNTRIES, 22).alias("native_country"),
        choice_column(key, WORK, 23).alias("workclass"),
        choice_column(key, JOBS, 24).alias("occupation"),
        F.when(F.col("c_mktsegment") == "BUILDING", "?").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("c_acctbal").alias("capital_gain"),
    )


def _choice_sql(values: list[str], seed: int) -> str:
    listed = ", ".join(f"'{v.lower()}'" for v in values)
    return f"[{listed}][CAST({hash_sql('c_custkey', seed=seed)} % {len(values)} AS INTEGER) + 1]"


def _recode_sql(c: str, mapping: dict[str, str]) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE {c} END"


CENSUS_SQL = f"""
raw AS (SELECT c_custkey, {_choice_sql(LEVELS, 21)} AS education, {_choice_sql(COUNTRIES, 22)} AS country, {_choice_sql(WORK, 23)} AS work,
               {_choice_sql(JOBS, 24)} AS job, lower(c_mktsegment) AS segment FROM customer),
grouped AS (SELECT c_custkey, {_recode_sql('education', EDUCATION)} AS education, CASE WHEN country = 'united-states' THEN 'us' ELSE 'non-us' END AS native_country,
               {_recode_sql('work', dict.fromkeys(UNDEFINED_WORK, 'undefined'))} AS workclass, {_recode_sql('job', dict.fromkeys(OTHER_WORK, 'other'))} AS occ, segment FROM raw),
census AS (SELECT c_custkey, education, native_country, workclass,
               CASE WHEN contains(education, 'graduate') AND occ = 'other' THEN 'other-2' ELSE occ END AS occupation, segment FROM grouped WHERE segment <> 'building')"""


@query("census_prepare", f"WITH {CENSUS_SQL} SELECT * FROM census")
def census_prepare(t: Tables) -> DataFrame:
    return prepare_census(census(t))


@query("census_split", f"WITH {CENSUS_SQL} SELECT education, {train_sql('c_custkey', seed=2)} AS is_train, count(*) AS n FROM census GROUP BY 1, 2")
def census_split(t: Tables) -> DataFrame:
    marked = split_random(prepare_census(census(t)), ["c_custkey"], 0.8, 2)
    return marked.groupBy("education", "is_train").agg(F.count(F.lit(1)).alias("n"))


def product_table(products: DataFrame, keywords: DataFrame) -> DataFrame:
    """All columns as text, descriptions combined and cleaned, keywords joined on."""
    products, keywords = C.cast_all(products), C.cast_all(keywords)
    described = C.combine_text(products, "desc", ";", "product_description")
    cleaned = described.withColumn("product_description", fn.remove_newlines_lower("product_description"))
    words = keywords.withColumn("keywords", fn.remove_newlines_lower("keywords"))
    return left_join_on([C.drop_matching(cleaned, "desc_"), words], "product_id")


@query("product_table", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, lower(p_brand || ';' || p_type || ';' || CAST(p_size AS VARCHAR)) AS product_description,
       replace(lower(p_name), ' ', ',') AS keywords FROM part""")
def q_product_table(t: Tables) -> DataFrame:
    products = t.part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("desc_1"),
        F.concat("p_type", F.lit("\n")).alias("desc_2"), F.col("p_size").alias("desc_3"),
    )
    words = t.part.select(F.col("p_partkey").alias("product_id"), F.translate("p_name", " ", ",").alias("keywords"))
    return product_table(products, words)
