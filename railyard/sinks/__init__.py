"""Writers: the partitioned store, CSV copies, run summaries and exports."""
