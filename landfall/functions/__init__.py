"""Spark SQL expression builders: SQL text in, SQL text out, JVM built-ins only.

A contract of N fields turns into one parsed expression per column list instead
of thousands of Column calls. Use them with ``F.expr``, ``selectExpr`` or inside
a query.
"""
