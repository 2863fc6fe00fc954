"""Training-data operators (LM scoring, PII, token counts, decontamination,
near-duplicates, toxicity, packing, exact substring removal, token-id files).

Nothing else in the library imports this subpackage. ``inforce.llm.queries``
registers one query per operator; ``corpus_pipeline.py`` at the repository top
chains five of them.
"""
