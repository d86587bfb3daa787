"""Writers of reports, graphs, ranks and comparisons."""
