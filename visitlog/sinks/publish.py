"""One output per analysis."""


def publish_all(results, base, fmt="parquet"):
    """Write each frame of ``{name: frame}`` to ``<base>/<name>``, replacing it.

    Returns ``{name: path}``. No frame is cached: the analyses read different
    columns of a columnar table, which is cheaper than keeping all of it.
    """
    paths = {name: f"{base.rstrip('/')}/{name}" for name in results}
    for name, df in results.items():
        df.write.mode("overwrite").format(fmt).save(paths[name])
    return paths
