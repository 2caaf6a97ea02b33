from tarmac.cli import main

main()
