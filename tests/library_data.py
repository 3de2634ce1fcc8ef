"""Input folder shared by the library tests."""

SF_SMALL = "/root/testdata/sf0.001"
