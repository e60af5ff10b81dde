"""Spark DataFrame jobs for a lending-and-payments event lake.

Raw JSON envelopes -> typed staging -> business rules -> star schema ->
reports, data-quality checks and exports.
"""
