"""Operators of a training-data pipeline: formatting, filters, near duplicates, decontamination, mixing."""
