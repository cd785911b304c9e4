"""logbeam.operators."""
