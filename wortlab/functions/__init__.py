"""Column expressions.  Everything here returns a ``Column`` built from
``pyspark.sql.functions`` so that it runs inside whole-stage codegen."""
