"""Clinical-document analytics as plain Spark DataFrame transformations.

One document is one row.  Everything that concerns a single document (its
elements, sections, entities, open questions, note) is computed inside that row
with built-in array and JSON functions, so it needs no shuffle and no grouping
key; shuffles are left for the work that really crosses documents.
"""
