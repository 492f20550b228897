"""The subpackage's queries and their oracle SQL."""

from functools import wraps

from methylspark.llm import fingerprint, langid, licenses, mixing, neardup, packing, secrets, spans, topk, training_order
from methylspark.llm.common import small_batches


def _bounded(query):
    """The query in a session with bounded Arrow batches."""
    return wraps(query)(lambda spark, sf_dir, **kw: query(small_batches(spark), sf_dir, **kw))


QUERIES = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_training_order": training_order.op3_training_order,
    "op4_span_dedup": spans.op4_span_dedup,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_language_id": langid.op6_language_id,
    "op7_pack_sequences": packing.op7_pack_sequences,
    "op8_near_duplicates": neardup.op8_near_duplicates,
    "op9_fingerprints": fingerprint.op9_fingerprints,
    "op10_topk_search": topk.op10_topk_search,
}
QUERIES = {name: _bounded(query) for name, query in QUERIES.items()}
ORACLES = {
    "op1_mix_sources": mixing.ORACLE,
    "op10_topk_search": topk.ORACLE,
}
