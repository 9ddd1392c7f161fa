"""Training-data operators: PII, quality, licences, WARC, deduplication,
decontamination, packing and token output. Nothing else in the library
imports this subpackage."""
