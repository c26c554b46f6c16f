"""Dense (array) and sparse (map) vector arithmetic inside the JVM."""

from pyspark.sql import functions as F


def _sum(values):
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b):
    """Null when a side is missing or empty; the longer side is cut to the shorter."""
    n = F.least(F.size(a), F.size(b))
    products = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n),
                          lambda x, y: x.cast("double") * y.cast("double"))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), _sum(products))


def norm(a):
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def round_vector(a, digits=5):
    return F.transform(a, lambda x: F.round(x, digits))


def map_norm(m):
    return F.sqrt(_sum(F.transform(F.map_values(m), lambda x: x * x)))


def by_hash(m):
    """The map with the 64-bit hash of each key in the key's place: a lookup reads keys one by one, and numbers compare
    far faster than texts."""
    return F.map_from_arrays(F.transform(F.map_keys(m), lambda k: F.xxhash64(k)), F.map_values(m))


def map_cosine(a, b, a_norm, b_norm):
    """Cosine of two token->weight maps; 0 when either is missing, empty or all zero."""
    shared = _sum(F.transform(F.map_entries(b), lambda e: e["value"] * F.coalesce(F.try_element_at(a, e["key"]), F.lit(0.0))))
    lengths = a_norm * b_norm
    return F.coalesce(F.when(lengths > 0, shared / lengths), F.lit(0.0))
