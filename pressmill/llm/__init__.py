"""Training-data operators: deduplication, decontamination, scoring, language, media and mixing."""
