"""License scan: whole texts in canonical form, looked up by digest among known licenses."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.license_texts import KNOWN

# Spellings that count as equal, the canonical one second.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"),
    ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"),
    ("categorise", "categorize"), ("centre", "center"), ("emphasised", "emphasized"), ("favour", "favor"),
    ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("maximise", "maximize"),
    ("modelled", "modeled"), ("modelling", "modeling"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("utilisation", "utilization"),
    ("whilst", "while"), ("wilful", "willful"),
)
# A line that starts with the word alone may be text that was wrapped there; a year or mark makes it a notice.
COPYRIGHT = r"\n[ \t]*(copyright[^\n]*([0-9]{4}|\(c\)|©)|\(c\)|©|all rights reserved)[^\n]*"
OTHERS = r"[^\p{L}\p{N}]+"
# Words stand between two spaces each, so that neighbours are replaced independently.
GAP = "  "


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines, words alone, equivalent spellings made one; null is empty."""
    lines = F.concat(F.lit("\n"), F.lower(F.coalesce(text, F.lit(""))))
    words = F.regexp_replace(F.regexp_replace(lines, COPYRIGHT, ""), OTHERS, GAP)
    out = F.concat(F.lit(GAP), F.btrim(words), F.lit(GAP))
    for variant, usual in SPELLINGS:
        out = F.replace(out, F.lit(f" {variant} "), F.lit(f" {usual} "))
    return out


def digest(text: Column) -> Column:
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def known_digests(spark: SparkSession, known: Iterable[tuple[str, str]] = KNOWN) -> DataFrame:
    """(digest, license_id) of known texts; texts with one canonical form go by the least id."""
    texts = spark.createDataFrame(list(known), "license_id string, body string")
    return texts.groupBy(digest(F.col("body")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, known: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, digest, and license_id where the whole text is a known license, else null.

    `known` (digest, license_id) joins by hash; Spark broadcasts it while it is small and shuffles both sides by
    digest otherwise. Null and empty texts have the digest of no words and no license. Repeated rows are looked
    up each; columns besides id and text are not read.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest"))
    return own.join(known, "digest", "left").select("doc_id", "digest", "license_id")


def canonical_sql(text: str) -> str:
    """The canonical form in portable SQL, for comparison on another engine."""
    out = f"regexp_replace(chr(10) || lower(coalesce({text}, '')), '{COPYRIGHT}', '', 'g')"
    out = f"'{GAP}' || trim(regexp_replace({out}, '{OTHERS}', '{GAP}', 'g')) || '{GAP}'"
    for variant, usual in SPELLINGS:
        out = f"replace({out}, ' {variant} ', ' {usual} ')"
    return out
