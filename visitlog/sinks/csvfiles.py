"""CSV export."""

from visitlog.functions.text import cell

# Writer options that give quoted cells with doubled quotes, empty
# cells with nothing between the commas, and outer spaces kept.
CELL_OPTIONS = {
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def export_csv(df, uri, header=True):
    """Replace the folder ``uri`` with CSV part files, each with a header.

    The cells of a single column are all quoted: a line that is empty or only
    spaces would be no record to a reader.
    """
    options = dict(CELL_OPTIONS)
    if len(df.columns) == 1:
        (name,) = df.columns
        df = df.select(cell(name).alias(name))
        options |= {"quoteAll": True, "emptyValue": '""'}
    df.write.mode("overwrite").options(header=header, **options).csv(uri)
