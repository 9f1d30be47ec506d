"""Training-data operators over document and page tables.

Ten operators (licence scan, near-duplicates, line de-duplication, personal data,
benchmark decontamination, quality rules, HTML extraction, web archives, quality
classifier, sub-word encoding), their registered queries and SQL twins. Nothing
outside this folder imports it.
"""
