"""The corpus pipeline: documents to packed sequences, in stages that each call one operator on all rows the one before kept.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `docs`.
Decisions hang on the rows of `docs` alone. Empty tables pass through every stage; null texts have no letter and go in the first.
"""

from placelens.llm import exact_dedup, langid, mixing, packing, simhash
from placelens.llm.common import importable, stored, table
from placelens.llm.queries import tokenizer_file


def language_id(spark, docs, sf_dir):
    """Learn from all rows with a language; documents without a letter go, and those that resemble no learned language."""
    importable(spark)
    return langid.accepted(docs, langid.profiles(docs))


def exact(spark, docs, sf_dir):
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.survivors(docs)


def near(spark, docs, sf_dir):
    """Of each component of linked fingerprints, the row with the smallest doc_id stays."""
    importable(spark)
    return simhash.survivors(docs)


def mixture(spark, docs, sf_dir):
    """Rows are repeated or left out so that every source comes near its target."""
    return mixing.mixed_rows(docs)


def packed(spark, docs, sf_dir):
    """The pieces of all documents in sequences of 1024 tokens."""
    importable(spark)
    return packing.pack(docs, tokenizer_file()).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing", mixture),
    ("packing", packed),
]

#: Language profiles, fingerprints, Newton steps and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to `documents`; what each of them keeps is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
