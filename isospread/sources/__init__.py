"""Tables in and out: file catalogues, cell tables, case lists, results."""
