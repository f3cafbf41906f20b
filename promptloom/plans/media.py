"""Item lists, combination prompts, image metadata."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import prompts, text
from ..operators import images, product
from ..session import run_path
from ..sources import readers, writers
from .registry import query, table, texts

_COMBINED = """FROM (SELECT DISTINCT p_name FROM part) i CROSS JOIN (SELECT DISTINCT p_brand FROM part) s
    CROSS JOIN (SELECT DISTINCT ' ' || p_type AS colour FROM part) c"""


def _combined(spark, sf):
    part = table(spark, sf, "part")
    styles = part.select(F.col("p_brand").alias("style")).distinct()
    colours = part.select(F.concat(F.lit(" "), "p_type").alias("colour")).distinct()
    return product.combinations_with(product.combinations_with(part.select("p_name").distinct(), styles, "style"), colours, "colour")


@query(
    "J1 R21 P2",
    f"""SELECT 'Create a concise description of ' || ltrim(colour) || ' ' || p_brand || ' ' || p_name
        || '. Do not mention brand names:' AS prompt {_COMBINED}""",
)
def description_prompts(spark, sf):
    return _combined(spark, sf).select(prompts.description("colour", "style", "p_name").alias("prompt"))


@query(
    "J1 R21",
    f"""SELECT 'Create a caption for this image of ' || ltrim(colour) || ' ' || p_brand || ' ' || p_name || ' :' AS prompt
        {_COMBINED}""",
)
def caption_prompts(spark, sf):
    return _combined(spark, sf).select(prompts.caption("colour", "style", "p_name").alias("prompt"))


@query(
    "J1",
    f"SELECT p_name, p_brand, colour AS p_type {_COMBINED}".replace("' ' || p_type AS colour", "p_type AS colour"),
)
def combinations_of_tables(spark, sf):
    part = table(spark, sf, "part")
    items = part.select("p_name").distinct()
    pairs = product.combinations_with(items, part.select("p_brand").distinct(), "p_brand", 10)
    return product.combinations_with(pairs, part.select("p_type").distinct(), "p_type", 4)


@query(
    "F5 F6 P7 A4",
    """WITH x AS (SELECT p_partkey, string_split(string_split('A list: 1. ' || p_name || ', 2. ' || p_type || ', , x, 3. ' || p_name || ': more', ':')[2], ', ') AS raw,
              string_split(string_split('Styles:1.-' || p_type || ' ,' || p_brand || ' ' || chr(10) || 'other', ':')[2], chr(10)) AS lines FROM part)
       SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(list_filter(raw, lambda r: r <> ''),
            lambda r: ltrim(r, '0123456789.- ')), lambda r: length(r) > 1))), '|') AS items,
        array_to_string(string_split(rtrim(ltrim(lines[1], '0123456789-. ')), ','), '|') AS styles FROM x""",
)
def parsed_lists(spark, sf):
    a_list = F.concat(
        F.lit("A list: 1. "), "p_name", F.lit(", 2. "), "p_type", F.lit(", , x, 3. "), "p_name", F.lit(": more")
    )
    styles = F.concat(F.lit("Styles:1.-"), "p_type", F.lit(" ,"), "p_brand", F.lit(" \nother"))
    items = F.array_distinct(text.longer_than(text.list_items(text.after_colon(a_list))))
    return table(spark, sf, "part").select(
        "p_partkey",
        F.array_join(F.array_sort(items), "|").alias("items"),
        F.array_join(text.first_line_items(text.after_colon(styles)), "|").alias("styles"),
    )


@query(
    "F5",
    """SELECT p_partkey, split_part(p_brand || ':' || p_name || ':' || p_type, ':', 2) AS piece,
       p_name || ':' || p_type AS rest, p_type AS line FROM part""",
)
def colon_pieces(spark, sf):
    x = F.concat_ws(":", "p_brand", "p_name", "p_type")
    return table(spark, sf, "part").select(
        "p_partkey",
        text.after_colon(x).alias("piece"),
        text.after_colon(x, keep_rest=True).alias("rest"),
        text.second_line(F.concat_ws("\n", "p_name", "p_type", "p_brand")).alias("line"),
    )


# Descriptions as a caption model would give them: prompt, colon, text.
DESCRIPTIONS_SQL = """(SELECT DISTINCT 'Describe ' || p_name || ': a ' || p_type || ' "' || p_name || '", by ' || p_brand AS description FROM part)"""

METADATA_SQL = f"""metadata AS (SELECT (row_number() OVER (ORDER BY sha256(description)) - 1)::VARCHAR || '.png' AS file_name,
    string_split(description, ':')[2] AS text FROM {DESCRIPTIONS_SQL})"""


def descriptions(spark, sf):
    return table(spark, sf, "part").select(
        F.concat(
            F.lit("Describe "), "p_name", F.lit(": a "), "p_type", F.lit(' "'), "p_name", F.lit('", by '), "p_brand"
        ).alias("description")
    )


def _metadata(spark, sf):
    """Metadata written as CSV with a header and read back."""
    path = run_path(spark, "metadata")
    writers.save_csv(images.image_metadata(images.image_prompts(descriptions(spark, sf))), path)
    schema = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("text", T.StringType())])
    return spark.read.csv(path, schema=schema, header=True, escape='"', ignoreLeadingWhiteSpace=False)


@query("N16 F5 F22 W1 K4", f"WITH {METADATA_SQL} SELECT * FROM metadata")
def image_metadata(spark, sf):
    return _metadata(spark, sf)


@query(
    "S9",
    f"""WITH {METADATA_SQL} SELECT p_partkey, m.text, TRUE AS is_png FROM part JOIN metadata m
        ON file_name = p_partkey::VARCHAR || '.png'""",
)
def image_files(spark, sf):
    """A small PNG file for each part beside the captions' CSV, read back as a folder of images."""
    path = run_path(spark, "images")
    writers.save_csv(images.image_metadata(images.image_prompts(descriptions(spark, sf))), f"{path}/metadata.csv")
    colour = F.pmod(F.xxhash64("p_partkey"), F.lit(1 << 24)).cast("int")
    named = texts(spark, sf, "part").select(text.file_name("p_partkey").alias("name"), colour.alias("colour"))
    writers.save_files(images.one_colour(named, "colour", "content"), path, "name", "content")
    found = readers.image_folder(spark, path)
    return found.select(
        F.substring_index("file_name", ".", 1).cast("bigint").alias("p_partkey"),
        "text",
        (F.substring("content", 2, 3).cast("string") == "PNG").alias("is_png"),
    )


@query(
    "J4",
    f"""WITH {METADATA_SQL} SELECT p_partkey, file_name, m.text FROM part JOIN metadata m
        ON file_name = p_partkey::VARCHAR || '.png'""",
)
def images_with_captions(spark, sf):
    pictures = table(spark, sf, "part").select("p_partkey", text.file_name("p_partkey").alias("file_name"))
    return images.with_captions(pictures, _metadata(spark, sf)).select("p_partkey", "file_name", "text")
