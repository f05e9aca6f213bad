"""Training-data operators: token counts, dedup, quality, language, licences,
decontamination, URL and toxicity filters.  Nothing else in the library
imports this subpackage."""
