"""From raw documents to token ids, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; all but the last return the columns of documents.
"""

from ledgerloom.llm.bpe import default_vocabulary, encode_documents
from ledgerloom.llm.common import read_table, staged
from ledgerloom.llm.mixing import mix_documents
from ledgerloom.llm.quality_model import drop_low_quality
from ledgerloom.llm.quality_rules import drop_rejected
from ledgerloom.llm.simhash import drop_near_duplicates


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the rules on repeats, length and lines shared in their source."""
    return drop_rejected(docs)


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier, trained on these documents' labels, does not reject."""
    return drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return drop_near_duplicates(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix of their sources takes them."""
    return mix_documents(docs)


def bpe_encode(spark, docs, sf_dir):
    """Token ids in place of texts."""
    return encode_documents(docs.select("doc_id", "lang", "source", "text"), default_vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", bpe_encode),
]
# The classifier's fit, the 64-bit digests and the merges are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
