"""mortarline: research-intelligence analytics on DataFrames.

Documents become pages, pages sentences, sentences classified events with
entities and measurements; the tables are then rolled up, scored and audited.
Everything is declared with the DataFrame API, so Catalyst plans it.
"""
