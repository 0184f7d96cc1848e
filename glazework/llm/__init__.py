"""Training-data operators on Spark: ten operators and the queries that apply them.

Nothing else in the library imports this subpackage; general helpers
(``glazework.session``) are imported from here.
"""
