"""Where the small tables are, for modules that cannot ask a fixture."""

DATA = "/root/testdata/sf0.001"
