"""Plans built from the operators.

``adapters``      entity roles on the driver's TPC-H-like tables
``flows``         profile → rule score → band → scored table
``queries``       the registered queries; ``oracle`` their SQL for DuckDB
``pipeline``      publish run on the driver tables; flagship query
``school``        the original batch run on the school tables
``school_views``  the original page's tables on the school gold tables
"""
