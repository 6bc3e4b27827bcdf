"""Training-data operators: fingerprints, near duplicates, classifiers, chat
formatting, vector search, mixing, substring dedup, packing, centroid
clustering, license scans and filter audits.

Nothing outside this package imports it.
"""
