from pyspark.sql import types as T

KINDS = {"int": T.IntegerType(), "smallint": T.ShortType(), "string": T.StringType(), "date": T.DateType()}


def layout(text: str) -> T.StructType:
    """"name type; name type; ..." as a schema, without a session."""
    schema = T.StructType()
    for item in text.split("; "):
        name, kind = item.split(" ")
        if kind.startswith("decimal"):
            schema.add(name, T.DecimalType(*[int(n) for n in kind[8:-1].split(",")]))
        else:
            schema.add(name, KINDS[kind])
    return schema
