"""End-to-end analyses over the source's own kinds of input (rating files, a labelled page
table, hourly demand, a folder of documents), composed from the operators. They take
DataFrames the caller reads (see the ``read_*`` helpers) and return DataFrames."""
