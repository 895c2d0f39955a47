"""Operations of a training-data pipeline over `documents` and `pages`.

One module per operator; `queries.QUERIES` and `queries.ORACLE` hold the
registered forms.  Nothing outside this package imports it.
"""
