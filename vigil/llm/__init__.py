"""Training-data operators: de-duplication, decontamination, filters, scoring,
mixing and output.  Nothing outside this package imports it."""
