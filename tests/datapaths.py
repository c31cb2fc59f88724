"""Where the tests find the driver's small tables."""

SF_SMALL = "/root/testdata/sf0.001"
