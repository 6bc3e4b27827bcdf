"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from . import (ann, centroids, chat, edit_fingerprint, filter_audit, licenses, minhash, mixing, packing, quality,
               suffix_array, suffix_tree, toxicity)
from .common import table


def _documents(fn):
    return lambda spark, sf_dir: fn(table(spark, sf_dir, "documents"))


def _labelled(fn):
    return lambda spark, sf_dir: fn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_document_fingerprints": _documents(edit_fingerprint.fingerprint_documents),
    "op2_minhash_near_dedup": _documents(minhash.link_documents),
    "op3_quality_classifier": _labelled(quality.score_documents),
    "op4_chat_formatting": lambda spark, sf_dir: chat.rendered(table(spark, sf_dir, "conversations")),
    "op5_permutation_index": lambda spark, sf_dir: ann.neighbours(table(spark, sf_dir, "embeddings")),
    "op6_mix_sources": _documents(mixing.mix_documents),
    "op7_substring_dedup": _documents(suffix_tree.dedup_documents),
    "op8_suffix_array_dedup": _documents(suffix_array.dedup_documents),
    "op9_toxicity": _labelled(toxicity.score_documents),
    "op10_best_fit_packing": _documents(packing.pack_documents),
    "op11_centroid_clustering": lambda spark, sf_dir: centroids.cluster_vectors(table(spark, sf_dir, "embeddings")),
    "op12_license_scan": _documents(licenses.scan),
    "op13_filter_audit": _labelled(filter_audit.audit),
}

ORACLE = {
    "op4_chat_formatting": chat.ORACLE,
    "op6_mix_sources": mixing.ORACLE,
    "op11_centroid_clustering": centroids.ORACLE,
    "op12_license_scan": licenses.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
