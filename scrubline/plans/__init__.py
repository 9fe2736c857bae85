"""The two report variants and the pipeline they share."""
