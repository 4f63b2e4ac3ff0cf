"""Operators for preparing text corpora, their registered queries and their SQL.

Every operator takes a DataFrame and column names and returns a DataFrame. It
reads only the columns that it names, so further columns of any name do no harm;
``keep`` (where there is one) carries more of them along. Nothing else in the
library imports this package.
"""
