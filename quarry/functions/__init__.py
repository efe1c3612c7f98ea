"""Column-expression builders.  All are built-in Spark expressions (whole-stage codegen);
none is a Python UDF."""
