"""Operations for preparing training text at scale.

Nothing outside this subpackage imports it.  ``catalogue.queries()`` lists the
registered queries and ``catalogue.oracle_sql()`` their SQL, where SQL can
express them.
"""
